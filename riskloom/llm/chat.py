"""Chat formatting: every assistant turn becomes an example whose context is all turns before it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import chunk_rank, join_null_safe, ranged, stored


@dataclass(frozen=True)
class Template:
    """Marks around a turn: ``opening`` role ``between`` text ``closing``.

    Inside roles and texts the escape character and the first characters of the
    marks are written as the escape character and a letter, so no mark can occur
    there and reading is the exact inverse.
    """

    opening: str = "### "
    between: str = ": "
    closing: str = "</turn>\n"
    trained_role: str = "assistant"

    #: character -> letter behind the escape character, which itself comes first
    def escapes(self) -> list[tuple[str, str]]:
        marks = dict.fromkeys(mark[0] for mark in (self.opening, self.between, self.closing))
        return [("\\", "b"), *[(mark, letter) for mark, letter in zip(marks, "xyz")]]

    def escaped(self, text: Column) -> Column:
        for mark, letter in self.escapes():
            text = F.replace(text, F.lit(mark), F.lit("\\" + letter))
        return text

    def unescaped(self, text: str) -> str:
        for mark, letter in reversed(self.escapes()):
            text = text.replace("\\" + letter, mark)
        return text

    def parsed(self, segment: str) -> tuple[str, str]:
        """Role and text of one formatted turn."""
        if not (segment.startswith(self.opening) and segment.endswith(self.closing)):
            raise ValueError("not a formatted turn")
        role, _, text = segment[len(self.opening) : -len(self.closing)].partition(self.between)
        return self.unescaped(role), self.unescaped(text)


def formatted_turns(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, pos, role, segment, start, text_start, text_end, trained): every turn, formatted once.

    ``start`` is the segment's place in its conversation's formatted text, in code
    points; ``text_start`` and ``text_end`` enclose the escaped text there. Turns
    follow ``turn``, then role and text, nulls first; null roles and texts are
    empty. Rows that repeat are turns of their own. Running totals are summed by
    ranges of (conv_id, turn), so a conversation of any length is many tasks.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(template.opening), template.escaped(F.col("role")), F.lit(template.between))
    body = template.escaped(F.col("text"))
    turns = turns.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.concat(head, body, F.lit(template.closing)).alias("segment"),
        F.length(head).cast("long").alias("head_chars"),
        F.length(body).cast("long").alias("body_chars"),
    )
    turns = turns.withColumn("chars", F.length("segment").cast("long")).withColumn("one", F.lit(1).cast("long"))
    turns = ranged(turns, ["conv_id", "turn"], 16_384, "chat-turns")
    turns = chunk_rank(turns, ["conv_id"], "_part", ["turn", "role", "text"], {"pos": "one", "start": "chars"})
    text_start = F.col("start") + F.col("head_chars")
    return turns.select(
        "conv_id",
        "pos",
        "role",
        "segment",
        "start",
        text_start.alias("text_start"),
        (text_start + F.col("body_chars")).alias("text_end"),
        (F.col("role") == template.trained_role).alias("trained"),
    )


def prefix_examples(turns: DataFrame) -> DataFrame:
    """(conv_id, target_pos, context_chars, loss_start, loss_end, example_chars): one row per assistant turn.

    The example's text is the conversation's formatted text up to the end of the
    target's segment, ``example_chars`` long: all turns before the target as
    context, then the target. Only the escaped text of the target, from
    ``loss_start`` to ``loss_end``, is trained on. Texts are not repeated in every
    example that has them as context, which would take space with the square of a
    conversation's length; :func:`spelled_out` writes them out.
    """
    return turns.where("trained").select(
        "conv_id",
        F.col("pos").alias("target_pos"),
        F.col("start").alias("context_chars"),
        F.col("text_start").alias("loss_start"),
        F.col("text_end").alias("loss_end"),
        (F.col("start") + F.length("segment")).alias("example_chars"),
    )


def spelled_out(turns: DataFrame, examples: DataFrame) -> DataFrame:
    """The examples with their whole ``text``, for a trainer that wants one string an example."""
    before = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    texts = turns.select("conv_id", F.col("pos").alias("target_pos"), F.array_join(F.collect_list("segment").over(before), "").alias("text"))
    return join_null_safe(examples, texts, ["conv_id", "target_pos"])


def write_examples(conversations: DataFrame, template: Template = Template()) -> tuple[DataFrame, DataFrame]:
    """Formatted turns and examples, written to the shared folder and opened again."""
    turns = stored(formatted_turns(conversations, template), "chat-segments")
    return turns, stored(prefix_examples(turns), "chat-examples")


_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_examples long, example_chars long"
)


def conversation_digests(turns: DataFrame, examples: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, read back from its written turns and examples.

    ``turns_sha256`` is over role, line feed, text, line feed of every turn;
    ``loss_chars`` and ``loss_sha256`` are over the unescaped text under the loss
    masks. Turns stream by in order, so memory does not grow with a conversation.
    """
    masks = examples.withColumnRenamed("target_pos", "pos")
    rows = join_null_safe(turns.select("conv_id", "pos", "segment", "start"), masks, ["conv_id", "pos"], "left")
    rows = rows.select("conv_id", "pos", "segment", "start", "loss_start", "loss_end", "example_chars")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: list | None = None
        done: list[list] = []
        for batch in batches:
            for conv, _, segment, start, low, high, chars in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or current[0] != conv:
                    if current:
                        done.append(current)
                    current = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                role, text = template.parsed(segment)
                current[1] += 1
                current[2].update(f"{role}\n{text}\n".encode())
                current[5] += len(segment)
                if low is not None:
                    trained = template.unescaped(segment[low - start : high - start])
                    current[3] += len(trained)
                    current[4].update(trained.encode())
                    current[6] += 1
                    current[7] += chars
            if len(done) > 4096:
                yield _digest_rows(done)
                done = []
        if current:
            done.append(current)
        if done:
            yield _digest_rows(done)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(digest, _DIGEST)


def _digest_rows(rows: list[list]) -> pa.RecordBatch:
    names = [field.split()[0] for field in _DIGEST.split(", ")]
    columns = [list(column) for column in zip(*rows)]
    for k in (2, 4):
        columns[k] = [hasher.hexdigest() for hasher in columns[k]]
    kinds = [pa.string() if "sha256" in name else pa.int64() for name in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
