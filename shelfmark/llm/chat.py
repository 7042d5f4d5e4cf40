"""Chat formatting with DataFrame functions only.

A template is plain data: how each role's turn opens and closes, whether its text is
trained on, and a finite-state machine over roles. Control strings inside texts are
escaped reversibly, so that the output can be parsed back without doubt.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEMPLATE = {
    "roles": {
        "system": {"open": "<<SYS>>", "close": "<</SYS>>", "loss": False},
        "user": {"open": "<s>[INST]", "close": "[/INST]", "loss": False},
        "assistant": {"open": "[OUT]", "close": "</s>", "loss": True},
    },
    #: any other role: its name is written out
    "other": {"open": "[ROLE]", "name_end": "[:]", "close": "[/ROLE]", "loss": False},
    "controls": ["<<SYS>>", "<</SYS>>", "<s>", "[INST]", "[/INST]", "[OUT]", "</s>", "[ROLE]", "[:]", "[/ROLE]"],
    "escape": "\\",
    "start": "start",
    "moves": {("start", "system"): "briefed", ("start", "user"): "asked", ("briefed", "user"): "asked", ("asked", "assistant"): "answered", ("answered", "user"): "asked"},
    "accept": ["answered"],
}


def escape(text: Column, template: dict = TEMPLATE) -> Column:
    """Double the escape character, then put one after the first character of each control string."""
    mark = template["escape"]
    text = F.replace(text, F.lit(mark), F.lit(mark * 2))
    for c in template["controls"]:
        text = F.replace(text, F.lit(c), F.lit(c[0] + mark + c[1:]))
    return text


def unescape(text: Column, template: dict = TEMPLATE) -> Column:
    mark = re.escape(template["escape"])
    return F.regexp_replace(text, f"{mark}({mark}?)", "$1")


def _segment(text: Column, loss) -> Column:
    return F.struct(text.alias("text"), (F.lit(loss) if isinstance(loss, bool) else loss).alias("loss"))


def _turn_segments(role: Column, text: Column, template: dict) -> Column:
    out = None
    for name, r in template["roles"].items():
        parts = F.array(_segment(F.lit(r["open"]), False), _segment(escape(text, template), r["loss"]), _segment(F.lit(r["close"]), False))
        out = F.when(role == name, parts) if out is None else out.when(role == name, parts)
    o = template["other"]
    head = F.concat(F.lit(o["open"]), escape(role, template), F.lit(o["name_end"]))
    return out.otherwise(F.array(_segment(head, False), _segment(escape(text, template), o["loss"]), _segment(F.lit(o["close"]), False)))


def format_conversations(rows: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """One row per ``conv_id``: ``formatted``, ``segments`` (text, loss), ``state``, ``valid``.

    Input ``conv_id, turn, role, text``; other columns are ignored. Null text and null role
    are empty strings; a null role is thus an unknown role. Turns are ordered by turn (nulls
    first), then role, then text, so that repeated turn numbers and repeated rows (which all
    stay) have one order. Null ``conv_id`` is a conversation of its own. Invalid turn orders
    are formatted all the same and have ``valid`` false. Very long texts are formatted whole; a conversation
    is one row. No rows give no rows.
    """
    role, text = F.coalesce(rows["role"].cast("string"), F.lit("")), F.coalesce(rows["text"].cast("string"), F.lit(""))
    turns = rows.select("conv_id", F.struct(rows["turn"].alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    turns = turns.withColumn("t", F.col("t").withField("segments", _turn_segments(F.col("t.role"), F.col("t.text"), template)))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    moves = F.create_map(*[F.lit(x) for (state, r), to in template["moves"].items() for x in (f"{state}|{r}", to)])
    state = F.aggregate(
        "turns", F.lit(template["start"]), lambda s, t: F.coalesce(F.try_element_at(moves, F.concat(s, F.lit("|"), t["role"])), F.lit("error"))
    )
    return grouped.select(
        "conv_id",
        F.flatten(F.transform("turns", lambda t: t["segments"])).alias("segments"),
        state.alias("state"),
    ).select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments", "state", F.col("state").isin(template["accept"]).alias("valid"))


def parse_formatted(formatted: Column, template: dict = TEMPLATE) -> Column:
    """The turns of a formatted conversation, as an array of (role, text), from its string alone."""
    o = template["other"]
    kinds = [(name, r["open"], r["close"]) for name, r in template["roles"].items()] + [(None, o["open"], o["close"])]
    pattern = "(?s)" + "|".join(f"{re.escape(a)}.*?{re.escape(b)}" for _, a, b in kinds)

    def turn(x):
        out = None
        for name, a, b in kinds:
            body = F.substring(x, F.lit(len(a) + 1), F.length(x) - (len(a) + len(b)))
            if name is None:
                at = F.locate(o["name_end"], x)
                role = unescape(F.substring(x, F.lit(len(a) + 1), at - (len(a) + 1)), template)
                body = F.substring(x, at + len(o["name_end"]), F.length(x) - (at + len(o["name_end"]) - 1) - len(b))
            else:
                role = F.lit(name)
            got = F.struct(role.alias("role"), unescape(body, template).alias("text"))
            out = F.when(x.startswith(a), got) if out is None else out.when(x.startswith(a), got)
        return out

    return F.transform(F.regexp_extract_all(formatted, F.lit(pattern), F.lit(0)), turn)


def loss_text(segments: Column, template: dict = TEMPLATE) -> Column:
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")
