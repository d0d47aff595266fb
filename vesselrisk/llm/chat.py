"""Chat formatting by token-level assembly.

Each turn is put together from segments that are encoded apart: reserved id ``TURN``, the role,
``SEP``, the text, ``END``. The reserved ids lie above the tokenizer's own, so no text can
produce them. Control strings inside roles and texts are escaped all the same, so that the rendered
form can be parsed too: a backslash goes after the first character of each control string,
and one more if there are some already, which makes the escape reversible. The loss mask
comes from prefix sums over +1 and -1 at the ends of the segments to learn; places of turns
in their conversation are prefix sums of turn lengths.

A row of the output is a turn: (conv_id, turn, start, ids, loss). A conversation is the ids of its rows in order of
``start``; turns are never gathered, so a conversation of any length stays within bounds.

Defined results: null texts and roles are empty; rows are ordered by turn (null first), then role and text; a null
conv_id is a conversation; repeated rows are turns of their own; an empty table gives an empty one; other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrow import slices
from .common import shared_path
from .tokens import encoder

TURN, SEP, END = 60_000, 60_001, 60_002  # reserved ids, above the ids of the tokenizer
MARKS = {TURN: "<|turn|>", SEP: "<|sep|>", END: "<|end|>"}
LEARNED_ROLE = "assistant"
# Control strings: <s> </s> <SYS>> </SYS>> [INST] [/INST] and all of the form <|name|>; none has "<" or "[" inside, so none overlap.
CONTROL = re.compile(r"<\\*(?=/?s>|/?SYS>>|\|[A-Za-z0-9_]+\|>)|\[\\*(?=/?INST\])")


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][:-1] if len(m[0]) > 1 else m[0], text)


def assemble(role: np.ndarray, text: np.ndarray, learn: bool) -> tuple[np.ndarray, np.ndarray]:
    """(ids, loss mask) of one turn."""
    ids = np.concatenate([[TURN], role, [SEP], text, [END]]).astype(np.uint32)
    change = np.zeros(len(ids) + 1, np.int8)
    change[len(role) + 2] += learn
    change[len(role) + 2 + len(text)] -= learn
    return ids, np.cumsum(change[:-1]).astype(bool)


def write_chats(turns: DataFrame, tokenizer: str, path: str | None = None) -> str:
    """Formats ``turns`` (conv_id, turn, role, text) and writes the table of turns; gives its folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = encoder(tokenizer, control_as_text=True)
        for batch in batches:
            for piece, texts in slices(batch, "text", 1 << 20):
                roles = [r or "" for r in piece.column(2).to_pylist()]
                kinds = sorted(set(roles))
                r_ids, r_sizes = to_ids.encode([escape(r) for r in kinds])
                role = dict(zip(kinds, np.split(r_ids, np.cumsum(r_sizes)[:-1])))
                ids, sizes = to_ids.encode([escape(t.decode()) for t in texts])
                rows = [assemble(role[r], t, r == LEARNED_ROLE) for r, t in zip(roles, np.split(ids, np.cumsum(sizes)[:-1]))]
                cols = [piece.column(0), piece.column(1), piece.column(2), piece.column(4)]
                cols += [pa.array([len(i) for i, _ in rows], pa.int64()), pa.array([i.astype("<u4").tobytes() for i, _ in rows], pa.binary())]
                cols += [pa.array([np.packbits(m).tobytes() for _, m in rows], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["conv_id", "turn", "role", "h", "n", "ids", "loss"])

    spark = turns.sparkSession
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").withColumn("h", F.xxhash64("text"))
    rows = rows.select("conv_id", "turn", "role", "text", "h")
    coded = rows.mapInArrow(run, "conv_id long, turn long, role string, h long, n long, ids binary, loss binary")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "h").rowsBetween(Window.unboundedPreceding, -1)
    path = path or shared_path(spark, "chats")
    coded.select("conv_id", "turn", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("start"), "ids", "loss").write.parquet(path)
    return path


@lru_cache(maxsize=4)
def _bytes_of(path: str) -> dict[int, bytes]:
    """The bytes behind each id of a byte-level BPE; reserved ids have none. Kept by the Python worker."""
    to_ids = encoder(path, control_as_text=True)
    back = {c: b for b, c in to_ids.chars.items()}
    return {i: bytes(back[c] for c in word) for word, i in to_ids.tokenizer.get_vocab(with_added_tokens=False).items() if all(c in back for c in word)}


class _Chat:
    """What is read back of one conversation, turn after turn."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.learned, self.n_chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: list[int], learn: list[bool], table: dict[int, bytes]) -> None:
        sep = ids.index(SEP)
        role, text = (b"".join(table[i] for i in part).decode() for part in (ids[1:sep], ids[sep + 1 : -1]))
        self.n_chars += len(role) + len(text) + sum(map(len, MARKS.values()))
        self.all.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
        learned = unescape(b"".join(table[i] for i, m in zip(ids, learn) if m).decode())
        self.learned += len(learned)
        self.loss.update(learned.encode())
        self.turns += 1

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.learned, self.loss.hexdigest(), self.n_chars


def read_chats(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """One row per conversation, parsed from the written ids and masks."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, chat, done = _bytes_of(tokenizer), None, []
        for batch in batches:  # in order of conversation and place; only digests are held
            for conv_id, ids, loss in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if chat is None or chat.conv_id != conv_id:
                    done += [chat.row()] if chat else []
                    chat = _Chat(conv_id)
                own = np.frombuffer(ids, "<u4")
                chat.add(own.tolist(), np.unpackbits(np.frombuffer(loss, np.uint8))[: len(own)].tolist(), table)
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in done], schema)
            done = []
        if chat:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, chat.row()))], schema)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.read.parquet(path).select("conv_id", "start", "ids", "loss")
    ordered = rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", "start")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
