"""Chat formatting: typed content parts are flattened into one template text per turn.

A visitor turns the parts of a message into text in their order: text parts are escaped, image, audio
and document parts become a placeholder each. Per turn it records the attachments (where their placeholder
stands, what they refer to, how many tokens they expand to) and the characters under the loss mask.
Text parts that follow one another are one text. A conversation is the pieces of its turns, one after the other; pieces
stay separate rows in order, so that a conversation of any length is formatted and read back as a stream: a reader finds
the turns by their marks alone.

Template: `[INST] text [/INST]` for the user, `text</s>` for the assistant, `[ROLE] role [/ROLE] text</s>`
for any other role. A control string inside a text (or a role) gets a backslash behind its first character, one more
than it had; reading back takes one away. So every text survives and no text can open or close a turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: All strings that mean something in the template.
CONTROL = ("s", "INST", "ROLE", "image", "audio", "document")
_ANY = f"/?(?:{'|'.join(CONTROL)})[>\\]]"
#: With capture groups: opening bracket, backslashes, rest.
ESCAPE = f"([<\\[])(\\\\*)({_ANY})"
UNESCAPE = f"([<\\[])\\\\(\\\\*)({_ANY})"
#: A content part. Images have width and height in pixels, audio has seconds, documents have pages.
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PATCH = 14
AUDIO_RATE = 25
PAGE_TOKENS = 512


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPE), F.lit(r"$1$2\\$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(UNESCAPE), F.lit("$1$2$3"))


def _joined(parts: Column) -> Column:
    """The parts with neighbouring texts put together, so that no control string can hide in two of them."""
    is_text = lambda p: ~F.coalesce(p["type"], F.lit("text")).isin("image", "audio", "document")

    def added(done: Column, p: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        both = p.withField("text", F.concat(F.coalesce(last["text"], F.lit("")), F.coalesce(p["text"], F.lit(""))))
        return F.when(
            (F.size(done) > 0) & is_text(last) & is_text(p), F.array_append(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), both)
        ).otherwise(F.array_append(done, p))

    return F.when(F.size(parts) < 2, parts).otherwise(F.aggregate(parts, F.slice(parts, 1, 0), added))


def _visit(part: Column) -> Column:
    """struct(text, type, ref, tokens) of a part: its text in the template; what it refers to and expands to, null for text."""
    kind = F.coalesce(part["type"], F.lit("text"))
    side = lambda x: F.ceil(F.coalesce(x, F.lit(0)) / PATCH)
    attached = kind.isin("image", "audio", "document")
    tokens = (
        F.when(kind == "image", side(part["width"]) * side(part["height"]))
        .when(kind == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE))
        .when(kind == "document", F.coalesce(part["pages"], F.lit(0)) * PAGE_TOKENS)
    ).cast("long")
    return F.struct(
        F.when(attached, F.concat(F.lit("<"), kind, F.lit(">"))).otherwise(escape(F.coalesce(part["text"], F.lit("")))).alias("text"),
        F.when(attached, kind).alias("type"), F.when(attached, part["ref"]).alias("ref"), tokens.alias("tokens"),
    )


def text_part(text: Column) -> Column:
    """The content of a message that is only text."""
    return F.array(F.struct(
        F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    ))


def format_chat(messages: DataFrame) -> DataFrame:
    """conv_id, turn, piece, loss_start, loss_chars, attachments, extra_tokens: one row per message.

    `messages` has conv_id, turn, role and content (an array of PART). piece is the template text; code points
    loss_start .. loss_start + loss_chars of it are trained on (assistant only, else 0 chars). attachments is
    an array of struct(position, type, ref, tokens), position a code point of the piece; extra_tokens their sum.
    Null role, content, part text: empty; a null or unknown part type is text. Null conv_id is a conversation, a null
    turn comes first. Repeated rows and equal turns stay. Empty tables give no row.
    """
    parts = F.filter(F.coalesce("content", F.from_json(F.lit("[]"), f"array<{PART}>")), lambda p: p.isNotNull())
    role = F.coalesce("role", F.lit(""))
    seen = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), F.transform(_joined(parts), _visit).alias("flat"))
    body = F.array_join(F.transform("flat", lambda p: p["text"]), "")
    head = (
        F.when(F.col("role") == "user", "[INST] ").when(F.col("role") == "assistant", "")
        .otherwise(F.concat(F.lit("[ROLE] "), escape(F.col("role")), F.lit(" [/ROLE] ")))
    )
    tail = F.when(F.col("role") == "user", " [/INST]").otherwise("</s>")
    located = seen.select("conv_id", "turn", "role", head.alias("head"), body.alias("body"), tail.alias("tail"), "flat")
    starts = F.transform("flat", lambda p, i: F.struct(
        (F.length("head") + F.aggregate(F.slice("flat", 1, i), F.lit(0), lambda n, q: n + F.length(q["text"]))).cast("long").alias("position"),
        p["type"].alias("type"), p["ref"].alias("ref"), p["tokens"].alias("tokens"),
    ))
    attachments = F.filter(starts, lambda p: p["type"].isNotNull())
    return located.select(
        "conv_id", "turn", F.concat("head", "body", "tail").alias("piece"),
        F.when(F.col("role") == "assistant", F.length("head")).otherwise(0).cast("long").alias("loss_start"),
        F.when(F.col("role") == "assistant", F.length("body")).otherwise(0).cast("long").alias("loss_chars"),
        attachments.alias("attachments"),
    ).withColumn("extra_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, p: n + F.coalesce(p["tokens"], F.lit(0).cast("long"))))


_UNESCAPE = re.compile(UNESCAPE)


def _plain(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


class Reader:
    """Turns of a conversation from its text, fed in any portions; it holds what has not ended yet."""

    def __init__(self):
        self.rest = ""

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        self.rest += text
        while turn := self._next():
            yield turn

    def _next(self) -> tuple[str, str] | None:
        rest, role, start, end = self.rest, "assistant", 0, "</s>"
        if rest.startswith("[INST] "):
            role, start, end = "user", 7, " [/INST]"
        elif rest.startswith("[ROLE] "):
            stop = rest.find(" [/ROLE] ", 7)
            if stop < 0:
                return None
            role, start = _plain(rest[7:stop]), stop + 9
        # an end can't be inside a text, where it has a backslash
        stop = rest.find(end, start)
        if stop < 0:
            return None
        self.rest = rest[stop + len(end) :]
        return role, _plain(rest[start:stop])


def read_turns(text: str) -> list[tuple[str, str]]:
    """Role and text of the turns of a formatted conversation (placeholders stay as they are)."""
    reader = Reader()
    turns = list(reader.feed(text))
    if reader.rest:
        raise ValueError("the text ends inside a turn")
    return turns


SUMMARY = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Read sorted pieces back, one conversation after the other; keeps two running digests and the turn it is in."""
    at, state = None, None

    def row():
        if state[5].rest:
            raise ValueError(f"conversation {at[0]} ends inside a turn")
        return (at[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

    for frame in frames:
        out = []
        for conv, piece, start, n in zip(frame["conv_id"], frame["piece"], frame["loss_start"], frame["loss_chars"]):
            key = (None if pd.isna(conv) else int(conv),)
            if key != at:
                if at:
                    out.append(row())
                at, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, Reader()]
            for role, text in state[5].feed(piece):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            loss = _plain(piece[start : start + n])
            state[2] += len(loss)
            state[3].update(loss.encode())
            state[4] += len(piece)
        yield _summary(out)
    if at:
        yield _summary([row()])


def _summary(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in SUMMARY.split(", ")])
    return frame.astype({"conv_id": "Int64"})


def read_back(pieces: DataFrame) -> DataFrame:
    """What SUMMARY names, per conversation, from the formatted pieces. One conversation is one stream in one task,
    as a digest of its turns in order has to be; the task's memory doesn't grow with it. Equal turns go by length of the trained text, then by piece."""
    return (
        pieces.select("conv_id", "turn", "piece", "loss_start", "loss_chars")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "loss_chars", "piece")
        .mapInPandas(_digests, SUMMARY)
    )
