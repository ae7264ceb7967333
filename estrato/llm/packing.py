"""Mixture-controlled packing: deficit round-robin over one queue per source.

Documents become token ids, an end id behind each. A source's queue is its documents in the order they
are read, cut into packets no longer than what the source is due in a round (its quantum: the window
length times its target share). In deficit round-robin a source is credited one quantum a round and
sends packets while its credit covers them; what is left is carried to the next round. The packet that
ends after c tokens of its queue is therefore sent in round ceil(c / quantum) - 1, whatever the other
queues hold. So the deficits that a task's queues begin with are the sums of the tasks before it, one number
per task and source, and every packet's round is known without a scheduler. Rounds laid end to end
are the stream: a running total over (round, source, place in queue) gives each packet its place,
and windows are cut from the stream wherever they end, so none but the last has room left. The rest
of the stream becomes sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from estrato.llm.common import Words, new_folder, record_batch, separator_table, sliced, stored, task_count

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_LETTER_OR_DIGIT = separator_table(b"abcdefghijklmnopqrstuvwxyz0123456789")
_PUNCTUATION = separator_table(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")

WINDOW = 4096
END = 2
LEAST_PACKET = 128
"""Packets of sources with a smaller quantum have up to this many tokens: their credit grows for some rounds first."""
KEPT_WORDS = 400_000
"""Encoded words that a task keeps; with more, only those of the last slice stay."""
JOINED_WORDS = 20_000


class Parts(Words):
    """Words, cut once more where an ASCII letter or digit is followed by ASCII punctuation.

    In the patterns that `falls_into_words` admits, a match always ends there.
    """

    def __init__(self, texts: list[bytes]):
        super().__init__(texts)
        cut = np.flatnonzero(_LETTER_OR_DIGIT[self.bytes[:-1]] & _PUNCTUATION[self.bytes[1:]]) + 1
        self.start, self.end = np.sort(np.concatenate([self.start, cut])), np.sort(np.concatenate([self.end, cut]))
        self.first = np.searchsorted(self.start, self.offset)


class Tokens:
    """A tokenizer of the `tokenizers` library, applied to distinct words where the text falls into words.

    Where white space is dropped and nothing else looks past it, a text's ids are those of its words.
    Each distinct word of a slice is then encoded once. Other tokenizers get whole texts.
    """

    def __init__(self, config: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(config)
        self.library.no_truncation()
        self.library.no_padding()
        self.by_word = falls_into_words(json.loads(config))
        self.added = [t["content"].encode() for t in json.loads(config).get("added_tokens", [])]
        self.kind = np.dtype("<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.hash, self.start, self.size, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.kind)

    def _encoded_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of each): words are encoded together, told apart by where a token begins."""
        ids, sizes = [], []
        for lo in range(0, len(words), JOINED_WORDS):
            part = words[lo : lo + JOINED_WORDS]
            found = self.library.encode(" ".join(part), add_special_tokens=False)
            begins = np.cumsum(np.fromiter((len(w) + 1 for w in part), np.int64, len(part)))
            at = np.searchsorted(begins, np.fromiter((a for a, _ in found.offsets), np.int64, len(found)), "right")
            ids.append(np.array(found.ids, self.kind))
            sizes.append(np.bincount(at, minlength=len(part)))
        return (np.concatenate(ids), np.concatenate(sizes)) if ids else (self.ids[:0], self.size[:0])

    def _learn(self, words: Words, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Places in the store of the distinct `hashes`, whose words begin at `first`; new ones are encoded."""
        if len(self.hash) > KEPT_WORDS:
            held = np.flatnonzero(np.isin(self.hash, hashes, assume_unique=True))
            self.ids = self.ids[spread(self.start[held], self.size[held])]
            self.hash, self.size = self.hash[held], self.size[held]
            self.start = np.cumsum(self.size) - self.size
        at = np.minimum(np.searchsorted(self.hash, hashes), max(len(self.hash) - 1, 0))
        new = np.flatnonzero(self.hash[at] != hashes) if len(self.hash) else np.arange(len(hashes))
        if len(new):
            ids, sizes = self._encoded_words([words.word(i).decode() for i in first[new].tolist()])
            order = np.argsort(joined := np.concatenate([self.hash, hashes[new]]), kind="stable")
            start = np.concatenate([self.start, len(self.ids) + np.cumsum(sizes) - sizes])
            self.hash, self.start, self.size = joined[order], start[order], np.concatenate([self.size, sizes])[order]
            self.ids = np.concatenate([self.ids, ids])
        return np.searchsorted(self.hash, hashes)

    def encode(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, an end id behind each; number of each)."""
        if not self.by_word:
            found = [np.array(x.ids + [end], self.kind) for x in self.library.encode_batch([t.decode() for t in texts], add_special_tokens=False)]
            return np.concatenate(found), np.array([len(x) for x in found], np.int64)
        # case and cuts inside words matter where a text may hold an added token
        plain = [x.translate(LOWER) for x in texts]
        words = Words(texts) if any(t in x for x in plain for t in self.added) else Parts(plain)
        hashes, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        place = self._learn(words, hashes, first)[which]
        sizes = self.size[place]
        total = np.concatenate(([0], np.cumsum(sizes)))
        ends = total[words.first[1:]]
        return np.insert(self.ids[spread(self.start[place], sizes)], ends, end), np.diff(total[words.first]) + 1


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + size[0] - 1, start[1] .. and so on."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def falls_into_words(config: dict) -> bool:
    """Whether the ids of a text are those of its parts between white space, one after the other."""

    def steps(of: dict | None, many: str) -> list[dict]:
        return [] if of is None else of[many] if of["type"] == "Sequence" else [of]

    normal, split = steps(config.get("normalizer"), "normalizers"), steps(config.get("pre_tokenizer"), "pretokenizers")
    plain = all(x["type"] in ("NFC", "Lowercase") or x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} and x["content"] == " " for x in normal)
    added = all(not (t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"])) for t in config.get("added_tokens", []))
    dropped = bool(split) and split[0]["type"] == "Split" and split[0]["behavior"] == "Removed" and split[0]["invert"] and r"[^\s" in split[0]["pattern"].get("Regex", "") and r"\s?" not in split[0]["pattern"]["Regex"]
    lower = any(x["type"] == "Lowercase" for x in normal)
    return plain and lower and added and dropped and all(x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"] for x in split[1:])


@functools.lru_cache(maxsize=2)
def _loaded(config: str) -> Tokens:
    return Tokens(config)


def config_text(spark: SparkSession, path: str) -> str:
    """The tokenizer file, by Spark's reader; a vocabulary of bounded size."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").head()[0]).decode()


def tokenized(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """Stored table (doc_id, source, part, row, at, n, ids) of `docs` (doc_id, text, source).

    (part, row) names a row. at is the number of tokens before it of rows of its source in its part, n its own; ids are packed numbers of 2 bytes, 4 if the vocabulary needs them.
    """
    spark = docs.sparkSession
    config = spark.sparkContext.broadcast(config_text(spark, path))
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("part", pa.int32()), ("row", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _loaded(config.value)
        part, row, queues = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            for lo, hi, texts in sliced(batch.column(1), 4 << 20):
                ids, sizes = tokens.encode(texts, end)
                bounds = np.concatenate(([0], np.cumsum(sizes))).tolist()
                sources = batch.column(2).slice(lo, hi - lo)
                at = []
                for source, n in zip(sources.to_pylist(), sizes.tolist()):
                    at.append(queues.get(source or "", 0))
                    queues[source or ""] = at[-1] + n
                packed = memoryview(ids.tobytes())
                width = ids.itemsize
                yield record_batch(schema, batch.column(0).slice(lo, hi - lo), sources, [part] * (hi - lo), range(row, row + hi - lo), at, sizes, [packed[a * width : b * width] for a, b in zip(bounds, bounds[1:])])
                row += hi - lo

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("source").cast("string"))
    found = found.mapInArrow(run, "doc_id long, source string, part int, row long, at long, n long, ids binary")
    folder = new_folder(spark, "token-ids")
    found.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(found.schema).parquet(folder)


def quanta(totals: DataFrame, tokens: int, window: int, shares: dict[str, float] | None) -> DataFrame:
    """`totals` (queue, total) with quantum: tokens a round by target share.

    `shares` gives targets by source. Sources it doesn't name divide what is left in proportion to
    their tokens; without it every source's target is its part of the corpus, so all queues last to the end.
    """
    if not shares:
        return totals.withColumn("quantum", F.col("total") * (window / tokens))
    if min(shares.values()) <= 0 or sum(shares.values()) > 1 + 1e-9:
        raise ValueError("target shares are above 0 and sum to at most 1")
    named = F.create_map(*[F.lit(x) for item in shares.items() for x in item])[F.col("queue")]
    rest = totals.filter(named.isNull()).agg(F.sum("total")).head()[0] or 1
    left = max(0.0, 1 - sum(shares.values()))
    return totals.withColumn("quantum", F.greatest(F.coalesce(named, F.col("total") * (left / rest)) * window, F.lit(1.0)))


def scheduled(rows: DataFrame, window: int, shares: dict[str, float] | None, least: int) -> DataFrame | None:
    """Stored packets (part, row, start, length, place) of the stream; None if there are no rows."""
    sums = stored(rows.groupBy(F.coalesce("source", F.lit("")).alias("queue"), "part").agg(F.sum("n").alias("sum")), "queue-sums")
    tokens = sums.agg(F.sum("sum")).head()[0]
    if not tokens:
        return None
    totals = quanta(sums.groupBy("queue").agg(F.sum("sum").alias("total")), tokens, window, shares)
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select("queue", "part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before")).join(totals, "queue")
    placed = rows.select(F.coalesce("source", F.lit("")).alias("queue"), "part", "row", "at", "n").join(begins, ["queue", "part"])
    placed = placed.withColumn("c", F.expr("before + at")).withColumn("most", F.greatest(F.lit(least), F.floor("quantum").cast("long")))
    packets = placed.select("part", "row", "queue", "c", "n", "most", "quantum", F.explode(F.expr("sequence(0, (n - 1) div most)")).alias("k"))
    packets = packets.select("part", "row", "queue", F.expr("k * most").alias("start"), F.expr("least(most, n - k * most)").alias("length"), "c", "quantum")
    packets = packets.withColumn("c", F.col("c") + F.col("start")).withColumn("round", F.ceil((F.col("c") + F.col("length")) / F.col("quantum")).cast("long"))
    order = ["round", "queue", "c"]
    return running_total(packets.drop("quantum"), order, "length").select("part", "row", "start", "length", "place")


def running_total(rows: DataFrame, order: list[str], size: str) -> DataFrame:
    """Stored `rows` with place: the sum of `size` over all rows before it in `order`.

    Tasks hold ranges of the order; one sum per task goes to the driver and back.
    """
    spark = rows.sparkSession
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column(batch.schema.get_field_index(size)).to_numpy()
            total = np.cumsum(sizes)
            more = [pa.array(total - sizes + done, pa.int64()), pa.array(np.full(len(sizes), task), pa.int32())]
            done += int(total[-1]) if len(total) else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "place", "task"])

    dealt = rows.repartitionByRange(task_count(spark), *order).sortWithinPartitions(*order)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema] + ["place long", "task int"]
    local = stored(dealt.mapInArrow(run, ", ".join(fields)), "running-total")
    sums, begin, begins = local.groupBy("task").agg(F.sum(size)).collect(), 0, []
    for task, n in sorted(map(tuple, sums)):
        begins.append((task, begin))
        begin += n
    begins = spark.createDataFrame(begins, "task int, begins long")
    return local.join(F.broadcast(begins), "task").withColumn("place", F.col("place") + F.col("begins")).drop("task", "begins")


def edges_of(tokens: int, window: int) -> tuple[int, np.ndarray]:
    """(full windows, ends of the sequences behind them): the rest in powers of two, largest first."""
    full, rest = divmod(tokens, window)
    powers = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    return full, full * window + np.cumsum(powers, dtype=np.int64)


def cut(doc: np.ndarray, start: np.ndarray, length: np.ndarray, place: np.ndarray, full: int, ends: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(doc, start, length, sequence, offset) of pieces, by doc and start: packets are joined where they touch and cut where sequences end."""
    order = np.lexsort((start, doc))
    doc, start, length, place = doc[order], start[order], length[order], place[order]
    head = np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + length[:-1]) | (place[1:] != place[:-1] + length[:-1])))
    at = np.flatnonzero(head)
    length = np.add.reduceat(length, at)
    doc, start, place = doc[at], start[at], place[at]

    def sequence(x: np.ndarray) -> np.ndarray:
        return np.where(x < full * window, x // window, full + np.searchsorted(ends, x, "right"))

    first, last = sequence(place), sequence(place + length - 1)
    of = np.repeat(np.arange(len(start)), last - first + 1)
    number = spread(first, last - first + 1)
    begins = np.concatenate(([full * window], ends))
    begin = np.where(number <= full, number * window, begins[np.clip(number - full, 0, len(ends))])
    finish = np.where(number < full, (number + 1) * window, begins[np.clip(number - full + 1, 0, len(ends))])
    lo, hi = np.maximum(begin, place[of]), np.minimum(finish, (place + length)[of])
    return doc[of], start[of] + lo - place[of], hi - lo, number, lo - begin


def packed(docs: DataFrame, path: str, window: int = WINDOW, end: int = END, shares: dict[str, float] | None = None, least: int = LEAST_PACKET, ids: bool = True) -> DataFrame:
    """Pieces of all documents: (doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids).

    `docs` has doc_id, text and source; other columns are ignored. A document's ids and the end id behind
    them lie in exactly one piece each. Sequences have `window` tokens, the last few, which hold the
    rest, a power of two; offsets of a sequence run from 0 without gaps. NULL and empty texts are the end id alone.
    Rows without source are a queue, shared with empty ones. Repeated rows and NULL ids are rows of their own; a
    very long text fills many windows. An empty table gives no pieces. ids (array<int>) is left out if not asked for.
    """
    spark = docs.sparkSession
    rows = tokenized(docs, path, end)
    fields = [("doc_id", pa.int64()), ("source", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * ids)
    ddl = "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * ids
    packets = scheduled(rows.drop("ids"), window, shares, least)
    if packets is None:
        return spark.createDataFrame([], ddl)
    full, ends = edges_of(rows.agg(F.sum("n")).head()[0], window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data in sliced(batch.column(3), 4 << 20):
                n = batch.column(2).slice(lo, hi - lo).to_numpy()
                packets = batch.column(4).slice(lo, hi - lo)
                doc, start, length, number, offset = cut(np.repeat(np.arange(hi - lo), pc.list_value_length(packets).to_numpy()), *(x.to_numpy() for x in packets.flatten().flatten()), full, ends, window)
                own = np.frombuffer(b"".join(data), f"<u{len(data[0]) // n[0]}").astype("<u4")
                raw, stop = memoryview(own.tobytes()), np.cumsum(length)  # pieces cover the documents in order
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((stop - length).tolist(), stop.tolist())]
                at = pa.array(doc)
                columns = [batch.column(0).slice(lo, hi - lo).take(at), batch.column(1).slice(lo, hi - lo).take(at), start, length, crc, n[doc], number, offset]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], stop)), pa.int32()), pa.array(own.view("<i4"))))
                yield record_batch(schema, *columns)

    of_doc = packets.groupBy("part", "row").agg(F.collect_list(F.struct("start", "length", "place")).alias("packets"))
    return rows.join(of_doc, ["part", "row"]).select("doc_id", "source", "n", "ids", "packets").mapInArrow(run, ddl)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the token ids of each sequence of `packed`, and the documents in it in order."""
    listed = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("of"))
    return listed.select("sequence_id", F.flatten(F.col("of.ids")).alias("ids"), F.col("of.doc_id").alias("doc_ids"))
