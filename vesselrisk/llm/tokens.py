"""Token-ID output: documents as ids in grammar-compressed binary shards with random access.

Documents are range-partitioned by id and sorted; each task encodes its documents with a
public tokenizer and cuts them into shards of about ``SHARD_TOKENS`` ids. A shard is
compressed by Re-Pair: rounds of replacing the most frequent adjacent id pairs by new
symbols (nonterminals), each with its rule and its expansion length, until no pair occurs twice.

File format: a Parquet table, so that any store Spark writes to will do and lost tasks leave
nothing behind. One row is a shard; its arrays are little-endian binaries:

    part, block     place in the order of all shards
    n_docs, n_tokens
    doc_ids         int64 per document     id_null   one byte per document, 1 for a null id
    doc_ends        uint64 per document    tokens up to its end, end id included
    rules           uint32 pairs           symbol ``N_TERMINALS + i`` stands for pair i
    lengths         uint32 per rule        ids that the symbol expands to
    sequence        uint32                 the compressed ids

Defined results: null texts are empty and consist of the end id alone; null ids come first;
rows with equal ids are in order of their texts' hash; an empty table gives no shards; other columns are not written.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrow import slices
from .common import shared_path

END_ID = 0
N_TERMINALS = 1 << 17  # above all ids of the tokenizers in use
SHARD_TOKENS = 1 << 20
PART_BYTES = 24 << 20
CACHE_WORDS = 300_000
GROUP = 32  # words a call of the model
SCHEMA = (
    "part int, block int, n_docs long, n_tokens long, doc_ids binary, id_null binary, doc_ends binary, rules binary, lengths binary, sequence binary"
)


def _byte_chars() -> dict[int, str]:
    """Byte-level BPE writes a byte as a character: printable Latin-1 as itself, the others from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(others)}}


class Encoder:
    """Whole texts to ids with the tokenizers library.

    The pre-tokenizer of a byte-level BPE never joins a character with a single space after
    it, so a text may be cut before each space that stands between two other characters.
    The ids of such words (with their space) are kept, up to ``CACHE_WORDS``. Words of Latin
    letters with punctuation, and two of them with a line feed between, go to the BPE model directly,
    ``GROUP`` words a call: letters, punctuation and line feeds are pre-tokens of their own, and the
    vocabulary is looked through once for tokens that would join them or reach over a space (if there
    are any, no word goes this way). All other words, and texts with other white space around a
    space, go through the whole tokenizer.
    """

    LETTERS, MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "!-&(-/:-@\\[-`{-~"
    WORD = re.compile(f"[{LETTERS}]+[{MARKS}]*(?:\n[{LETTERS}]+[{MARKS}]*)?")

    def __init__(self, path: str, control_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = control_as_text
        # Strings that the tokenizer takes out of a text before it looks at words: such a text is encoded in one piece.
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.reserved = [t.content for t in added if not (control_as_text and t.special)]
        self.model = self.tokenizer.model
        self.chars = _byte_chars()
        vocabulary = self.tokenizer.get_vocab(False)
        self.apart = self._keeps_apart(vocabulary)
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # tokens with a space before them
        self.begins[[i for token, i in vocabulary.items() if token.startswith(self.chars[32])]] = True
        self.at: dict[str, int] = {}
        self.starts, self.lengths = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)
        self.ids, self.n_ids = np.empty(1 << 18, np.uint32), 0

    def _keeps_apart(self, vocabulary: dict[str, int]) -> bool:
        """No token of the bytes of ``WORD`` and spaces has letters beside punctuation or a line feed, or a space but in front."""
        of = lambda codes: "".join(re.escape(self.chars[b]) for b in codes)
        letters = of(b for b in range(256) if chr(b).isascii() and chr(b).isalpha() or 0x80 <= b < 0xC0 or 0xC3 <= b <= 0xC9)
        marks = of(b for b in range(128) if re.match(f"[{self.MARKS}]", chr(b)))
        space, line = self.chars[32], self.chars[10]
        used = re.compile(f"[{letters}{marks}{space}{line}]*")
        fine = re.compile(f"{space}?(?:[{letters}]*|[{marks}]*)|[{space}{line}]*")
        model = self.model
        plain = not (model.ignore_merges or model.dropout or model.continuing_subword_prefix or model.end_of_word_suffix)
        return plain and all(fine.fullmatch(t) for t in vocabulary if used.fullmatch(t))

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, plain: list[str], other: list[str]) -> np.ndarray:
        """Places of the ids of words with a space before them; the words are kept while there is room."""
        got = array("I")
        for i in range(0, len(plain), GROUP):
            text = " " + " ".join(plain[i : i + GROUP])
            got.extend([t.id for t in self.model.tokenize(text.encode().decode("latin-1").translate(self.chars))])
        first = np.nonzero(self.begins[np.frombuffer(got, np.uint32)])[0] if got else np.empty(0, np.int64)
        lengths = [np.diff(first, append=len(got))]
        for w in other:
            ids = self._whole(" " + w)
            got.extend(ids)
            lengths.append([len(ids)])
        lengths = np.concatenate(lengths)
        n, m, total = len(self.at), len(lengths), len(got)
        while n + m > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while self.n_ids + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.n_ids : self.n_ids + total] = got
        self.starts[n : n + m], self.lengths[n : n + m] = self.n_ids + np.cumsum(lengths) - lengths, lengths
        if n + m <= CACHE_WORDS:
            self.n_ids += total
            self.at.update(zip(plain + other, range(n, n + m)))
        return np.arange(n, n + m)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text)."""
        if not texts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        distinct = cut.values.dictionary_encode()
        words = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        plain, other = [], []
        for i in np.nonzero(place == -1)[0].tolist():
            w = words[i]
            if self.apart and self.WORD.fullmatch(w):
                plain.append(i)
            elif w and not w[0].isspace() and not w[-1].isspace():
                other.append(i)
        if plain or other:
            place[plain + other] = self._learn([words[i] for i in plain], [words[i] for i in other])
        which = place[distinct.indices.to_numpy()]
        firsts = cut.values.take(pa.array(bounds[:-1])).to_pylist()
        which[bounds[:-1]] = -2  # first words have no space before them
        whole = set((np.searchsorted(bounds, np.nonzero(which == -1)[0], side="right") - 1).tolist())
        whole.update(i for i, w in enumerate(firsts) if w[-1:].isspace() or not w)
        whole.update(i for i, t in enumerate(texts) if any(r in t for r in self.reserved))
        for i in whole:
            which[bounds[i] : bounds[i + 1]] = -2
        own = np.where(which < 0, 0, self.lengths[which])
        sums = np.concatenate(([0], np.cumsum(own)))
        begin = [self._whole(texts[i] if i in whole else w) for i, w in enumerate(firsts)]
        n_begin = np.fromiter(map(len, begin), np.int64, len(begin))
        lengths = n_begin + sums[bounds[1:]] - sums[bounds[:-1]]
        ids, rest = np.empty(int(lengths.sum()), np.uint32), np.ones(int(lengths.sum()), bool)
        at = ragged(np.cumsum(lengths) - lengths, n_begin)
        rest[at] = False
        ids[at] = np.fromiter(chain.from_iterable(begin), np.uint32, len(at))
        which = which[which >= 0]
        ids[rest] = self.ids[ragged(self.starts[which], self.lengths[which])]
        return ids, lengths


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, control_as_text: bool = False) -> Encoder:
    """One encoder a Python worker, kept from task to task. ``control_as_text``: control strings in a text are ordinary text."""
    if (path, control_as_text) not in _ENCODERS:
        _ENCODERS[path, control_as_text] = Encoder(path, control_as_text)
    return _ENCODERS[path, control_as_text]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs [start, start + length), one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def repair(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rules as pairs of symbols, compressed sequence); no pair of the sequence is left that occurs twice without overlap.

    A round counts pairs exactly and replaces those that occur twice or more wherever no overlapping pair is more
    frequent. A pair that has a rule from an earlier round takes its symbol. The most frequent pair of a
    round always goes, so rounds end by themselves; only places whose pair may occur again are looked at.
    """
    rules, known = [np.empty((0, 2), np.uint32)], []  # known: pairs and symbols of each round, in order of the pairs
    n_rules, fresh = 0, np.ones(len(seq), bool)
    seq = np.array(seq, np.uint32)
    while True:
        fresh[-1:] = False
        at = np.nonzero(fresh)[0]
        if not len(at):
            break
        key, at, same = _by_pair(seq, at)
        starts = np.nonzero(np.concatenate(([True], key[1:] != key[:-1])))[0]
        count = np.diff(starts, append=len(key))
        often = np.nonzero(count >= 2)[0]
        if not len(often):
            break
        pairs, none = key[starts[often]], len(often)
        rank = np.full(len(starts), none, np.int32)
        rank[often[np.argsort(-count[often], kind="stable")]] = np.arange(none)
        of = np.repeat(rank, count)
        live = np.nonzero(of < none)[0]
        places, of = at[live], of[live]
        own = np.full(len(seq) + 2, none, np.int32)  # of place i at i + 1
        own[places + 1] = of
        take = np.nonzero((of <= own[places]) & (of <= own[places + 2]))[0]
        spots, by = places[take], of[take]
        uses = np.bincount(by, minlength=none)[rank[often]]  # in order of ``pairs``
        symbol = np.zeros(none, np.uint32)
        for old, symbols in known:
            i = np.minimum(np.searchsorted(old, pairs), len(old) - 1)
            symbol = np.where(old[i] == pairs, symbols[i], symbol)
        back = symbol[(symbol > 0) & (uses > 0)]
        made = (symbol == 0) & (uses >= 2)
        symbol[made] = N_TERMINALS + n_rules + np.arange(int(made.sum()))
        if made.any():
            known.append((pairs[made], symbol[made]))
            rules.append(np.stack([pairs[made] >> np.uint64(32), pairs[made] & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32))
            n_rules += len(rules[-1])
        of_rank = np.zeros(none, np.uint32)
        of_rank[rank[often]] = symbol
        put = of_rank[by]
        some = np.nonzero(put)[0]
        spots, put = spots[some], put[some]
        fresh = np.zeros(len(seq), bool)
        for i in (places, same, spots, spots[spots > 0] - 1):
            fresh[i] = True
        seq[spots] = put
        stay = np.ones(len(seq), bool)
        stay[spots + 1] = False
        stay = np.nonzero(stay)[0]
        seq, fresh = seq[stay], fresh[stay]
        if len(back):  # such a symbol may stand where it makes a pair that occurred once before
            met = np.zeros(N_TERMINALS + n_rules, bool)
            met[back] = True
            met = met[seq]
            fresh |= met
            fresh[:-1] |= met[1:]
    return np.concatenate(rules), seq


def _by_pair(seq: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, places) of the places ``at`` in order of pair, of a run of one symbol every second place; and all places of such runs."""
    a, b = seq[at], seq[at + 1]
    same = np.nonzero(a == b)[0]
    keep = np.ones(len(at), bool)
    if len(same):
        k = np.arange(len(same))
        begins = np.concatenate(([True], np.diff(at[same]) > 1))
        keep[same[((k - np.maximum.accumulate(np.where(begins, k, 0))) & 1) == 1]] = False
    kept = np.nonzero(keep)[0]
    a, b = a[kept].astype(np.uint64), b[kept]
    width, bits = int(max(a.max(), b.max())).bit_length(), len(at).bit_length()
    if 2 * width + bits > 64:
        key = (a << np.uint64(32)) | b
        order = np.argsort(key, kind="stable")
        return key[order], at[kept[order]], at[same]
    # Pair and place in one number: a plain sort is several times faster.
    key = (a << np.uint64(width + bits)) | (b.astype(np.uint64) << np.uint64(bits)) | kept.astype(np.uint64)
    key.sort()
    places = at[(key & np.uint64((1 << bits) - 1)).astype(np.int64)]
    key >>= np.uint64(bits)
    return ((key >> np.uint64(width)) << np.uint64(32)) | (key & np.uint64((1 << width) - 1)), places, at[same]


def _turns(rules: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rules that only use symbols of earlier ranges."""
    last = np.where(rules >= N_TERMINALS, rules.astype(np.int64) - N_TERMINALS, -1).max(axis=1, initial=-1)
    reach, i = np.maximum.accumulate(last), 0
    while i < len(rules):
        end = int(np.searchsorted(reach, i))
        yield i, end
        i = end


def rule_lengths(rules: np.ndarray) -> np.ndarray:
    """Ids that each rule's symbol expands to."""
    lengths = np.zeros(len(rules), np.int64)
    inner = rules >= N_TERMINALS
    child = np.where(inner, rules.astype(np.int64) - N_TERMINALS, 0)
    for i, end in _turns(rules):
        lengths[i:end] = np.where(inner[i:end], lengths[child[i:end]], 1).sum(axis=1)
    return lengths


def expansions(rules: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, ids): what each symbol expands to; terminals are not in it."""
    lengths = rule_lengths(rules)
    ends = np.cumsum(lengths)
    start, flat = ends - lengths, np.empty(ends[-1] if len(ends) else 0, np.uint32)
    for i, end in _turns(rules):
        flat[start[i] : ends[end - 1]] = _spell(rules[i:end].reshape(-1), start, lengths, flat[: start[i]])[0]
    return start, lengths, flat


def _spell(symbols: np.ndarray, start: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids per symbol)."""
    inner = symbols >= N_TERMINALS
    rule = np.where(inner, symbols.astype(np.int64) - N_TERMINALS, 0)
    sizes = np.where(inner, lengths[rule] if len(lengths) else 1, 1)
    both = np.concatenate([flat, symbols])  # a terminal stands for itself
    begin = np.where(inner, start[rule] if len(start) else 0, len(flat) + np.arange(len(symbols)))
    return both[ragged(begin, sizes)], sizes


def decode(rules: np.ndarray, seq: np.ndarray) -> np.ndarray:
    return _spell(seq, *expansions(rules))[0]


def decode_range(rules: np.ndarray, lengths: np.ndarray, seq: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a shard: only the symbols that reach into the range are expanded."""
    if stop <= start:
        return np.empty(0, np.uint32)
    inner = seq >= N_TERMINALS
    ends = np.cumsum(np.where(inner, lengths[np.where(inner, seq.astype(np.int64) - N_TERMINALS, 0)] if len(lengths) else 1, 1))
    a, b = int(np.searchsorted(ends, start, side="right")), int(np.searchsorted(ends, stop - 1, side="right")) + 1
    ids = decode(rules, seq[a:b])
    skip = start - (int(ends[a - 1]) if a else 0)
    return ids[skip : skip + stop - start]


def write_tokens(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> str:
    """Writes the shards of all documents in ascending order of ``doc_id``; gives the folder."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    order = ["doc_id", "h", "at"]  # rows of one id are dealt over several parts if they are many
    ordered = (
        rows.withColumns({"h": F.xxhash64("text"), "at": F.monotonically_increasing_id()})
        .repartitionByRange(max(1, -(-int(total) // PART_BYTES)), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, part, block = encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids, counts, keys, n = [], [], [], 0
        for batch in batches:
            for piece, texts in slices(batch, "text", 1 << 20):
                own, lengths = to_ids.encode([t.decode() for t in texts])
                key = piece.column(0)  # copied: a slice would hold its whole batch
                keys.append((np.array(key.fill_null(0), "<i8"), np.array(key.is_null(), np.uint8)))
                ids.append(np.insert(own, np.cumsum(lengths), END_ID).astype(np.uint32))
                counts.append(lengths + 1)
                n += len(ids[-1])
                if n >= SHARD_TOKENS:
                    yield _shard(part, block, ids, counts, keys)
                    ids, counts, keys, n, block = [], [], [], 0, block + 1
        if n:
            yield _shard(part, block, ids, counts, keys)

    path = path or shared_path(spark, "tokens")
    ordered.mapInArrow(run, SCHEMA).write.parquet(path)
    return path


def _shard(part: int, block: int, ids: list, counts: list, keys: list) -> pa.RecordBatch:
    seq, ends = np.concatenate(ids), np.cumsum(np.concatenate(counts))
    key, null = (np.concatenate(c) for c in zip(*keys))
    rules, packed = repair(seq)
    lengths = rule_lengths(rules).astype(np.uint32)
    row = {
        "part": (part, pa.int32()),
        "block": (block, pa.int32()),
        "n_docs": (len(key), pa.int64()),
        "n_tokens": (len(seq), pa.int64()),
        "doc_ids": (key.tobytes(), pa.binary()),
        "id_null": (null.tobytes(), pa.binary()),
        "doc_ends": (ends.astype("<u8").tobytes(), pa.binary()),
        "rules": (rules.astype("<u4").tobytes(), pa.binary()),
        "lengths": (lengths.astype("<u4").tobytes(), pa.binary()),
        "sequence": (packed.astype("<u4").tobytes(), pa.binary()),
    }
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in row.values()], names=list(row))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, part, block, offset) of each document, decoded from the files."""
    shards = spark.read.schema(SCHEMA).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(k)[i].as_py() for k, c in enumerate(batch.schema.names)}
                ids = decode(np.frombuffer(r["rules"], "<u4").reshape(-1, 2), np.frombuffer(r["sequence"], "<u4")).astype("<u4")
                ends = np.frombuffer(r["doc_ends"], "<u8").astype(np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(ends)
                null = np.frombuffer(r["id_null"], np.uint8).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(r["doc_ids"], "<i8"), pa.int64(), mask=null),
                        pa.array(np.full(n, r["part"]), pa.int32()),
                        pa.array(np.full(n, r["block"]), pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(ends - starts, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "part", "block", "offset", "n_tokens", "ids_crc32"],
                )

    # Tokens before a shard: those of earlier parts (one row a part), then of earlier blocks of the part.
    sizes = shards.select("part", "block", "n_tokens")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before(Window.orderBy("part"))), F.lit(0)).alias("of_parts")
    )
    blocks = sizes.select(
        "part", "block", F.coalesce(F.sum("n_tokens").over(before(Window.partitionBy("part").orderBy("block"))), F.lit(0)).alias("of_blocks")
    )
    base = blocks.join(parts, "part").select("part", "block", (F.col("of_parts") + F.col("of_blocks")).alias("base"))
    docs = shards.mapInArrow(run, "doc_id long, part int, block int, offset long, n_tokens long, ids_crc32 long")
    return docs.join(base, ["part", "block"]).select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "part", "block", "offset"
    )
