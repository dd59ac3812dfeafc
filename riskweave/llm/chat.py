"""Chat formatting with typed content parts.

A message is a list of parts, struct<kind, text, ref, amount>.  A visitor
flattens the parts, in order, into one body: text parts as escaped text,
image, audio and document parts as placeholders; it records for each
attachment its place, kind, reference and the tokens its placeholder expands
to.  Everything up to the digests is built-in column expressions, one row per
message, without a shuffle: the formatted text of a conversation is its rows'
``formatted`` in the order of turn (null first), then of ``formatted``.

Template: ``<s>[INST] BODY [/INST]</s>`` for the role ``user``,
``<s> BODY </s>`` for ``assistant``, ``<s>[ROLE]ROLE[/ROLE] BODY</s>`` for any
other role.  A control string inside a text or role gets a backslash after
its first character (one more if it has some), so that the formatted text has
control strings only where the template put them; ``unescape`` takes it off.

Edge cases: a null text is empty, a null role is the empty role, a null part
list has no parts, a part of unknown or null kind counts as text; a null
conv_id is a conversation of its own; rows that are equal are all kept; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the template's control strings
BEGIN, END = "<s>", "</s>"
USER_BEGIN, USER_END = "[INST] ", " [/INST]"
ROLE_BEGIN, ROLE_END = "[ROLE]", "[/ROLE] "
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
_AFTER_FIRST = r"s>|/s>|/?INST\]|/?ROLE\]|\|(?:image|audio|document)\|>"

PARTS_TYPE = "array<struct<kind:string,text:string,ref:string,amount:double>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_AFTER_FIRST})", r"$1\\$2$3")


_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_AFTER_FIRST})")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


class PartVisitor:
    """Column expressions for one part of each kind; subclass to change sizes or placeholders."""

    #: pixels, seconds and pages (``amount``) per token
    pixels_per_token = 784.0
    tokens_per_second = 25.0
    tokens_per_page = 256.0

    def text(self, part: Column) -> Column:
        return escape(F.coalesce(part["text"], F.lit("")))

    def image(self, part: Column) -> Column:
        return F.lit(PLACEHOLDER["image"])

    def audio(self, part: Column) -> Column:
        return F.lit(PLACEHOLDER["audio"])

    def document(self, part: Column) -> Column:
        return F.lit(PLACEHOLDER["document"])

    def tokens(self, part: Column) -> Column:
        amount = F.greatest(F.coalesce(part["amount"], F.lit(0.0)), F.lit(0.0))
        size = (F.when(part["kind"] == "image", amount / self.pixels_per_token)
                .when(part["kind"] == "audio", amount * self.tokens_per_second)
                .otherwise(amount * self.tokens_per_page))
        return F.greatest(F.ceil(size), F.lit(1)).cast("long")

    def visit(self, part: Column) -> Column:
        kind = part["kind"]
        return (F.when(kind == "image", self.image(part)).when(kind == "audio", self.audio(part))
                .when(kind == "document", self.document(part)).otherwise(self.text(part)))

    def body(self, parts: Column) -> Column:
        return F.array_join(F.transform(parts, self.visit), "")

    def attachments(self, parts: Column) -> Column:
        """array<struct<place, kind, ref, tokens>>: ``place`` counts the message's parts from 0."""
        placed = F.transform(parts, lambda p, i: F.struct(i.alias("place"), p["kind"].alias("kind"), p["ref"].alias("ref"),
                                                          self.tokens(p).alias("tokens")))
        return F.filter(placed, lambda a: F.coalesce(a["kind"].isin(*PLACEHOLDER), F.lit(False)))


def text_parts(text: Column) -> Column:
    """One text part: the part list of a message that is plain text."""
    none = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            none.cast("string").alias("ref"), none.cast("double").alias("amount")))


def format_messages(df: DataFrame, parts: Column, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", visitor: PartVisitor | None = None) -> DataFrame:
    """(conv_id, turn, formatted, loss_start, loss_end, attachments, attachment_tokens), one row per message.

    The loss mask is the code points [loss_start, loss_end) of ``formatted``: an assistant's body, else null.
    """
    visitor = visitor or PartVisitor()
    role = F.coalesce(F.col(f"`{role_col}`"), F.lit(""))
    parts = F.coalesce(parts.cast(PARTS_TYPE), F.array().cast(PARTS_TYPE))
    rows = df.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"),
                     visitor.body(parts).alias("body"), visitor.attachments(parts).alias("attachments"))
    answer = F.col("role") == "assistant"
    head = (F.when(F.col("role") == "user", F.lit(BEGIN + USER_BEGIN)).when(answer, F.lit(BEGIN + " "))
            .otherwise(F.concat(F.lit(BEGIN + ROLE_BEGIN), escape(F.col("role")), F.lit(ROLE_END))))
    tail = F.when(F.col("role") == "user", F.lit(USER_END + END)).when(answer, F.lit(" " + END)).otherwise(F.lit(END))
    start = F.when(answer, F.lit(len(BEGIN) + 1).cast("long"))
    return rows.select("conv_id", "turn", F.concat(head, "body", tail).alias("formatted"), start.alias("loss_start"),
                       (start + F.length("body")).alias("loss_end"), "attachments",
                       F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"))


_TURN = re.compile(r"<s>(?:\[INST\] (?P<user>.*?) \[/INST\]|\[ROLE\](?P<role>.*?)\[/ROLE\] (?P<other>.*?)| (?P<answer>.*?) )</s>",
                   re.DOTALL)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn in a stretch of formatted text; placeholders stay in the text."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text outside a turn")
        at = m.end()
        if m["user"] is not None:
            out.append(("user", unescape(m["user"])))
        elif m["answer"] is not None:
            out.append(("assistant", unescape(m["answer"])))
        else:
            out.append((unescape(m["role"]), unescape(m["other"])))
    if at != len(formatted):
        raise ValueError("text outside a turn")
    return out


def read_conversations(messages: DataFrame) -> DataFrame:
    """Digests of the conversations read back from formatted messages: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars.

    Rows of a conversation meet in one task in order and stream through it: memory is one Arrow batch,
    however long the conversation (its digest is sequential by definition).
    """
    conv = messages.schema["conv_id"].dataType.simpleString()
    rows = (messages.select("conv_id", "turn", "formatted", "loss_start", "loss_end").repartition("conv_id")
            .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "formatted").drop("turn"))
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = f"conv_id {conv}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now = None

        def close() -> None:
            if now is not None:
                done.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))

        conv_type = None
        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for conv_id, text, lo, hi in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now[0] != conv_id:
                    close()
                    now = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in parse_turns(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{body}\n".encode())
                if lo is not None:
                    loss = unescape(text[lo:hi])
                    now[3] += len(loss)
                    now[4].update(loss.encode())
                now[5] += len(text)
            if done:
                yield _rows(done, names, conv_type)
                done.clear()
        close()
        if done:
            yield _rows(done, names, conv_type)

    return rows.mapInArrow(run, schema)


def _rows(rows: list[tuple], names: list[str], conv_type: pa.DataType) -> pa.RecordBatch:
    types = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
