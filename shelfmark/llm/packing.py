"""Packing of tokenized documents into sequences by vector best fit.

Every sequence has three capacities: tokens, pieces (documents) and attention cost (the sum
of squared piece lengths). A piece goes to the open sequence that it fits under all three
and that scores best, by the weighted norm of what would be left or by the weighted dot
product of piece and residual. A capacity weighs as much as the pieces ask of it on average, if no
weights are given. Pieces are packed in groups of bounded size, longest first.

Where tokens alone are limited, as in the registered query, the other two capacities follow from
that limit: they take part in the choice of a sequence but never close one.
"""

from __future__ import annotations

import base64
import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, text_column
from .words import chunks

MAX_TOKENS = 2048
#: Pieces that one task packs together.
GROUP_PIECES = 8192
END = 0
_ENCODINGS: dict[str, tiktoken.Encoding] = {}


def vocabulary_path() -> str:
    """The ranks of ``byte_bpe_50k.json``, whose ids they equal, in the faster engine's format."""
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _encoding(path: str) -> tiktoken.Encoding:
    if path not in _ENCODINGS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def tokenize(docs: DataFrame, doc_id: str, text: str, *, piece_tokens: int = MAX_TOKENS, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Cut each document's ids, ended by id 0, into pieces of at most ``piece_tokens``.

    Only longer documents are cut, and then the first piece may be the shorter one. Columns:
    ``doc_id, piece, start, length, ids_crc32`` and, on demand, ``ids``. Null and empty texts
    are the id 0 alone; repeated rows each have their pieces; special tokens' strings in a
    text are ordinary text. Very long texts are tokenized whole; no documents give no pieces; columns of
    other names do not matter.
    """
    rows = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), text_column(docs, text).alias("text"))
    path = vocabulary or vocabulary_path()

    def pieces(batches):
        encode = _encoding(path).encode_to_numpy
        for batch in batches:
            texts = batch.column("text")
            sizes = np.cumsum(np.append(0, [len(t) for t in (x.as_py() or "" for x in texts)]))
            for a, b in chunks(sizes):
                out: dict[str, list] = {k: [] for k in ("at", "piece", "start", "length", "crc", "ids")}
                for i in range(a, b):
                    ids = np.append(encode(texts[i].as_py() or "", disallowed_special=()), np.uint32(END)).astype("<u4")
                    n, first = len(ids), len(ids) % piece_tokens or piece_tokens
                    for k, s in enumerate([0, *range(first, n, piece_tokens)]):
                        part = ids[s : first + k * piece_tokens]
                        for key, v in zip(out, (i, k, s, len(part), zlib.crc32(part.tobytes()), part), strict=True):
                            out[key].append(v)
                arrays = [batch.column("doc_id").take(pa.array(out["at"], pa.int64())), pa.array(out["piece"], pa.int32()), *(pa.array(out[k], pa.int64()) for k in ("start", "length", "crc"))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    flat = np.concatenate(out["ids"]) if out["ids"] else np.zeros(0, "<u4")
                    offsets = np.cumsum(np.append(0, out["length"])).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return rows.mapInArrow(pieces, schema)


def best_fit(lengths: np.ndarray, capacity: np.ndarray, weights: np.ndarray | None = None, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; pieces are placed from the longest to the shortest, equal ones in their order, in the
    first of equally good bins. No pieces need no bin."""
    size = np.stack([lengths, np.ones_like(lengths), lengths**2], axis=1).astype(np.float64)
    if weights is None:
        weights = (size / capacity).mean(axis=0) if len(lengths) else np.ones(3)
    left = np.empty((max(len(lengths), 1), 3))
    ids = np.empty(len(left), dtype=np.int64)  # which bins are still open
    n_open = n_bins = 0
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    least = lengths.min() if len(lengths) else 0
    for i in order:
        v = size[i]
        room = left[:n_open]
        fits = np.flatnonzero((room[:, 0] >= v[0]) & (room[:, 1] >= v[1]) & (room[:, 2] >= v[2]))
        if len(fits):
            if rule == "norm":
                score = (((room[fits] - v) / capacity) ** 2) @ weights
                k = fits[np.argmin(score)]
            else:
                score = (room[fits] * v / capacity**2) @ weights
                k = fits[np.argmax(score)]
        else:
            k = n_open
            left[k], ids[k] = capacity, n_bins
            n_open, n_bins = n_open + 1, n_bins + 1
        bins[i], offsets[i] = ids[k], capacity[0] - left[k, 0]
        left[k] -= v
        if left[k, 0] < least or left[k, 1] < 1 or left[k, 2] < least**2:  # full: the last open bin takes its row
            n_open -= 1
            left[k], ids[k] = left[n_open], ids[n_open]
    return bins, offsets


def pack(
    pieces: DataFrame, *, max_tokens: int = MAX_TOKENS, max_pieces: int | None = None, max_attention: int | None = None,
    weights: tuple[float, float, float] | None = None, rule: str = "norm", group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (any columns, ``length`` among them).

    Pieces that fill a sequence are one by themselves. The others are dealt evenly into
    groups of about ``group_pieces``, each packed in one task; a group leaves about one
    sequence half empty, which is all that dividing the work costs. A null length is an
    error of the caller; equal lengths are taken in any order; no pieces give no rows.
    """
    capacity = np.array([max_tokens, max_pieces or max_tokens, max_attention or max_tokens**2], dtype=np.float64)
    pieces = pieces.drop("sequence_id", "offset")
    items = table(pieces.withColumn("__item", F.monotonically_increasing_id()), "pieces")
    small = F.col("length") < max_tokens
    n = items.where(small).count()
    groups = max(1, math.ceil(n / group_pieces))
    w = np.array(weights) if weights is not None else None

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__item")
        bins, offsets = best_fit(pdf["length"].to_numpy(np.int64), capacity, w, rule)
        return pd.DataFrame({"__item": pdf["__item"], "sequence_id": (key[0] << 32) + bins, "offset": offsets})

    narrow = items.where(small).select("__item", "length", F.pmod(F.xxhash64("__item"), F.lit(groups)).alias("g"))
    placed = narrow.groupBy("g").applyInPandas(run, "__item long, sequence_id long, offset long")
    placed = items.where(small).join(placed, "__item")
    alone = items.where(~small).withColumns({"sequence_id": -F.col("__item") - 1, "offset": F.lit(0).cast("long")})
    return placed.unionByName(alone).drop("__item")


def pack_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", max_tokens: int = MAX_TOKENS, max_pieces: int | None = None, max_attention: int | None = None, vocabulary: str | None = None, with_ids: bool = False, **options) -> DataFrame:
    """Tokenize and pack. A piece is never too large for an empty sequence: it is cut to fit the attention cost too."""
    longest = min(max_tokens, math.isqrt(max_attention)) if max_attention else max_tokens
    pieces = tokenize(docs, doc_id, text, piece_tokens=longest, vocabulary=vocabulary, with_ids=with_ids)
    return pack(pieces, max_tokens=max_tokens, max_pieces=max_pieces, max_attention=max_attention, **options)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence of ``pack_documents(with_ids=True)``: its ids, and where each document's piece lies."""
    part = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    rows = packed.groupBy("sequence_id").agg(part.alias("p"))
    return rows.select(
        "sequence_id",
        F.flatten(F.col("p.ids")).alias("ids"),
        F.transform("p", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["piece"].alias("piece"), x["offset"].alias("offset"), x["length"].alias("length"))).alias("parts"),
    )
