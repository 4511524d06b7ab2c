"""Phrases whose words keep company: frequent phrases of two to five words, scored by their weakest cut.

Texts are cut at punctuation into pieces and those into words. A phrase's score is the smallest, over its cuts in two
parts, of ``1000 * a * n / (l * r)``: how much more often the parts meet than they would by chance.

1. Texts become chunks of about ``CHUNK`` words of one language, never cut inside a text: a list of different words with
   their counts, and the text as places in that list. They are written once, and no text is read again.
2. Word counts are summed in Spark; frequent words get ids in order of language and frequency. A chunk gets the ids of its
   own words by a join, so a dictionary never outgrows its chunk.
3. In each chunk pairs of neighbouring ids are counted in tiles of ``SIDE`` by ``SIDE`` ids: as the ids are ranked, few
   tiles hold most pairs. A tile with many pairs is counted directly by its cells (``numpy.bincount``), all sparse tiles
   together as sorted coordinates. The counts travel as sorted, compressed columns, dealt by hash of the phrase into as
   many parts as keep a part small, and are summed there.
4. Of the frequent phrases a bit map of a fixed size (``BITS``) goes to all tasks. Phrases of a chunk whose bit is unset
   are not frequent; the others are ranked anew by their counts in the chunk, and pairs of neighbouring ones, which are
   phrases longer by one word, are counted in the same way. A bit set by another phrase only lets more phrases be
   counted: what is frequent is decided by the sums. Every part of a frequent phrase is frequent, so nothing is missed.

Phrases that lie in a longer one with (nearly) the same count are dropped; one word more is enough to look at, since
counts never grow with length. NULL texts have no words, a NULL language is ``und``. Repeated rows count again. Other
columns are ignored. A text may be of any length; it is split a slice at a time. An empty table gives no rows.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensormill.llm.fingerprints import mix
from sensormill.workspace import materialise

#: Words of a chunk (a text more); the open chunks of a task hold four times as many.
CHUNK = 1 << 21
#: Bytes of a text that are split at once.
SLICE = 1 << 20
#: Ids along a tile's side; a tile with a pair for every ``DENSE`` cells is counted directly.
SIDE, DENSE = 256, 4
#: Counts that one part sums (a part holds those of the same phrases from all chunks).
PART = 1 << 20
#: Bits of the map of frequent phrases (4 MB), and the factor of its hash: sums stay below 64 bits.
BITS, FACTOR = (1 << 25) - 39, 1_000_003
#: Bits of one piece of the map, as Spark's functions build it.
_PIECE = 1 << 15
#: Groups in which each language's phrases are ranked before the best of all groups are.
SALTS = 256

#: The lowest-scoring cut of a row (a, n, heads, tails). Products may pass 64 bits: decimals of 38 digits are exact, and
#: DIV gives the whole part.
LOWEST_CUT = """array_min(transform(arrays_zip(heads, tails), (c, k) -> struct(
  (1000 * cast(a as decimal(16, 0)) * cast(n as decimal(17, 0))) div (cast(c.heads as decimal(16, 0)) * cast(c.tails as decimal(16, 0))) as score,
  k as k, c.heads as l, c.tails as r)))"""

_CUTS = b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _CUTS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(_CUTS))


def split_words(body: bytes) -> Iterator[list[bytes]]:
    """The words of a text, lower-cased, with a line feed where a piece ends; empty ones stand for repeated blanks."""
    begin = 0
    while begin < len(body):
        end = begin + SLICE
        if end < len(body):
            at = [p for p in (body.find(c, end) for c in (b" ", b"\t", b"\n", b".", b",")) if p >= 0]
            end = min(at, default=len(body))
        yield body[begin:end].translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")
        begin = end


class _Open:
    """A chunk that texts are still added to."""

    def __init__(self):
        self.places: dict[bytes, int] = {b"": 0, b"\n": 1}
        self.text = array("i")

    def add(self, body: bytes) -> None:
        places = self.places
        for words in split_words(body):
            self.text.extend([places.setdefault(word, len(places)) for word in words])
        self.text.append(1)

    def row(self, number: int, lang: str) -> pa.RecordBatch:
        text = np.frombuffer(self.text, dtype=np.int32)
        text = text[text != 0] - 2
        counts = np.bincount(text[text >= 0], minlength=len(self.places) - 2)
        order = np.argsort(-counts, kind="stable")
        place = np.append(np.empty_like(order), -1)  # gaps look up the last one
        place[order] = np.arange(len(order))
        text, counts = place[np.maximum(text, -1)], counts[order]
        words = pa.array(list(self.places)[2:], pa.binary()).take(pa.array(order)).cast(pa.string())
        columns = [
            pa.array([number], pa.int64()), pa.array([lang]), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
            pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([packed(text)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "lang", "word", "count", "text"])


def broken(text: np.ndarray) -> np.ndarray:
    """Places with every run of gaps (negative) as one gap."""
    text = np.where(text < 0, -1, text).astype(np.int32)
    keep = np.ones(len(text), dtype=bool)
    keep[1:] = (text[1:] >= 0) | (text[:-1] >= 0)
    return text[keep]


def packed(text: np.ndarray) -> bytes:
    """Places, gaps as 0, byte by byte of their size: the higher bytes are mostly alike."""
    planes = (broken(text) + 1).astype(np.uint32).view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(text: pa.Scalar) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(text.as_py()), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64) - 1


def _chunks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, _Open] = {}
        waiting = 0
        for batch in batches:
            for lang, body in zip(batch["lang"].to_pylist(), batch["body"], strict=True):
                own = held.setdefault(lang, _Open())
                before = len(own.text)
                own.add(body.as_py())
                waiting += len(own.text) - before
                done = list(held) if waiting >= 4 * size else [lang] if len(own.text) >= size else []
                for name in done:
                    full = held.pop(name)
                    waiting -= len(full.text)
                    number += 1
                    yield full.row(number, name)
        for name, own in held.items():
            number += 1
            yield own.row(number, name)

    return run


def tile_counts(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs (x, y), how often each occurs, and for each given pair its place among them."""
    if not len(x):
        return x, y, x, x
    across = int(y.max()) // SIDE + 1
    tile = (x // SIDE) * across + y // SIDE
    tiles, where, sizes = np.unique(tile, return_inverse=True, return_counts=True)
    dense = sizes * DENSE >= SIDE * SIDE
    place = np.empty(len(x), dtype=np.int64)
    found_x, found_y, found_n, total = [], [], [], 0

    def add(pairs_x: np.ndarray, pairs_y: np.ndarray, n: np.ndarray) -> None:
        nonlocal total
        found_x.append(pairs_x)
        found_y.append(pairs_y)
        found_n.append(n)
        total += len(n)

    order = np.argsort(where, kind="stable")
    begins = np.searchsorted(where[order], np.arange(len(tiles) + 1))
    for t in np.flatnonzero(dense).tolist():
        own = order[begins[t] : begins[t + 1]]
        cell = (x[own] % SIDE) * SIDE + y[own] % SIDE
        table = np.bincount(cell, minlength=SIDE * SIDE)
        used = np.flatnonzero(table)
        place[own] = total + (np.cumsum(table > 0) - 1)[cell]
        corner_x, corner_y = tiles[t] // across * SIDE, tiles[t] % across * SIDE
        add(corner_x + used // SIDE, corner_y + used % SIDE, table[used])
    rest = np.flatnonzero(~dense[where])
    if len(rest):
        rest = rest[np.lexsort((y[rest], x[rest]))]
        first = np.ones(len(rest), dtype=bool)
        first[1:] = (x[rest][1:] != x[rest][:-1]) | (y[rest][1:] != y[rest][:-1])
        place[rest] = total + np.cumsum(first) - 1
        begin = np.flatnonzero(first)
        add(x[rest][begin], y[rest][begin], np.diff(np.append(begin, len(rest))))
    return np.concatenate(found_x), np.concatenate(found_y), np.concatenate(found_n), place


def _counted(chunk: pa.Array, now: np.ndarray, grams: np.ndarray) -> pa.RecordBatch:
    """The chunk of phrases longer by one word: ``now`` are places of phrases among ``grams``, -1 where there is none."""
    x, y = now[:-1], now[1:]
    both = np.flatnonzero((x >= 0) & (y >= 0))
    pairs_x, pairs_y, n, place = tile_counts(x[both], y[both])
    longer = np.concatenate([grams[pairs_x], grams[pairs_y, -1:]], axis=1)
    order = np.lexsort(longer.T[::-1])
    sorted_place = np.empty_like(order)
    sorted_place[order] = np.arange(len(order))
    out = np.full(max(len(now) - 1, 0), -1, dtype=np.int64)
    out[both] = sorted_place[place]
    columns = [chunk, pa.array([len(order)], pa.int64()), pa.array([pack_counts(longer[order], n[order])], pa.binary()), pa.array([packed(out)], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["chunk", "size", "counts", "text"])


def pack_counts(grams: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted phrases (rows of word ids) and their counts, by column; of the first word only the steps."""
    first = np.diff(grams[:, 0], prepend=0)
    columns = [c.astype(np.uint32 if c.max(initial=0) < 1 << 32 else np.uint64) for c in (first, *grams.T[1:], n)]
    head = bytes([len(columns), *(c.itemsize for c in columns)])
    return head + zstandard.compress(b"".join(c.tobytes() for c in columns), 1)


def unpack_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    sizes = list(data[1 : 1 + data[0]])
    content = zstandard.decompress(data[1 + len(sizes) :])
    rows, at, columns = len(content) // sum(sizes), 0, []
    for size in sizes:
        columns.append(np.frombuffer(content, dtype=np.uint32 if size == 4 else np.uint64, count=rows, offset=at).astype(np.int64))
        at += rows * size
    columns[0] = np.cumsum(columns[0])
    return np.stack(columns[:-1], axis=1), columns[-1]


def _names(size: int) -> list[str]:
    return [f"w{i}" for i in range(size)]


_COUNTED = "chunk long, size long, counts binary, text binary"


def _first_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From chunks with the ids of their frequent words to chunks of pairs."""
    for batch in batches:
        for row in range(batch.num_rows):
            text, entries = unpacked(batch["text"][row]), batch["known"][row].values
            place, ids = (entries.field(c).to_numpy(zero_copy_only=False) for c in ("place", "id"))
            order = np.argsort(ids)
            # Ranks among the chunk's own frequent words; gaps look up the last one.
            ranks = np.full(max(int(text.max(initial=-1)), int(place.max(initial=-1))) + 2, -1, dtype=np.int64)
            ranks[place[order]] = np.arange(len(order))
            yield _counted(batch["chunk"].slice(row, 1), ranks[text], ids[order][:, None].astype(np.int64))


def hashed(grams: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The bit of each phrase, a row of word ids; ``_bit`` in Spark."""
    out = np.zeros(len(grams), dtype=np.int64)
    for word in grams.T:
        out = (out * FACTOR + word) % bits
    return out


def _bit(names: list[str], bits: int) -> Column:
    out = F.lit(0).cast("bigint")
    for name in names:
        out = (out * FACTOR + F.col(name)) % bits
    return out


def _bit_map(frequent: DataFrame, size: int, bits: int) -> np.ndarray:
    """One bit per hash of the frequent phrases. It is built in pieces by Spark, and its size is fixed."""
    at = F.col("_at") + 1
    used = frequent.select(_bit(_names(size), bits).alias("_at"))
    pieces = used.groupBy(F.bitmap_bucket_number(at).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros((bits // _PIECE + 1, _PIECE // 8), dtype=np.uint8)
    for row in pieces.collect():
        out[row.piece - 1, : len(row.bits)] = np.frombuffer(row.bits, dtype=np.uint8)
    return out.ravel()


def _longer(bit_map: np.ndarray, bits: int):
    """From chunks of phrases to those of one word more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                grams, n = unpack_counts(batch["counts"][row].as_py())
                at = hashed(grams, bits)
                open_ = np.flatnonzero((bit_map[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
                open_ = open_[np.argsort(-n[open_], kind="stable")]
                ranks = np.full(len(grams) + 1, -1, dtype=np.int64)
                ranks[open_] = np.arange(len(open_))
                yield _counted(batch["chunk"].slice(row, 1), ranks[unpacked(batch["text"][row])], grams[open_])

    return run


def _dealt(parts: int):
    """From chunks to (part, counts): the phrases of each part, still sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch["counts"]:
                grams, n = unpack_counts(data.as_py())
                part = mix(hashed(grams).astype(np.uint64)) % np.uint64(parts)
                order = np.argsort(part, kind="stable")
                rims = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
                used = np.flatnonzero(np.diff(rims))
                own = [order[rims[p] : rims[p + 1]] for p in used.tolist()]
                content = [pack_counts(grams[o], n[o]) for o in own]
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(content, pa.binary())], ["part", "counts"])

    return run


def add_up(grams: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different phrases, sorted, with the sums of their counts."""
    every, counts = np.concatenate(grams), np.concatenate(n)
    order = np.lexsort(every.T[::-1])
    every, counts = every[order], counts[order]
    first = np.ones(len(every), dtype=bool)
    first[1:] = (every[1:] != every[:-1]).any(axis=1)
    return every[first], np.add.reduceat(counts, np.flatnonzero(first)) if len(counts) else counts


def _summed(least: int):
    """From rows sorted by part to (words of a phrase..., a) for those frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, grams, n, waiting = None, [], [], 0

        def finished() -> Iterator[pa.RecordBatch]:
            if grams:
                every, sums = add_up(grams, n)
                kept = np.flatnonzero(sums >= least)
                columns = [pa.array(c) for c in (*every[kept].T, sums[kept])]
                yield pa.RecordBatch.from_arrays(columns, [*_names(len(columns) - 1), "a"])

        for batch in batches:
            for part, data in zip(batch["part"].to_pylist(), batch["counts"], strict=True):
                if part != current:
                    yield from finished()
                    current, grams, n, waiting = part, [], [], 0
                more = unpack_counts(data.as_py())
                grams.append(more[0])
                n.append(more[1])
                waiting += len(more[1])
                if waiting > 2 * PART:
                    total = add_up(grams, n)
                    grams, n, waiting = [total[0]], [total[1]], 0
        yield from finished()

    return run


def _sums(chunks: DataFrame, size: int, least: int) -> DataFrame:
    """(words of a phrase..., a): the phrases of all chunks that occur often enough."""
    spark = chunks.sparkSession
    total = chunks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART))
    rows = chunks.select("counts").mapInArrow(_dealt(parts), "part long, counts binary")
    dealt = rows.repartition(parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(_summed(least), ", ".join(f"{c} long" for c in (*_names(size), "a")))


def _ranked(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``rows`` with ``id``: their place in the order, from 0. Only one number per partition reaches the driver."""
    placed = materialise(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33).cast("int")
    sizes = {r.part: r.n for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    begins = np.concatenate([[0], np.cumsum([sizes.get(p, 0) for p in range(max(sizes, default=0) + 1)])]).tolist()
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("id", within + F.element_at(F.lit(begins).cast("array<bigint>"), part + 1)).drop("_at")


def phrases(docs: DataFrame, longest: int = 5, least: int = 100, chunk: int = CHUNK, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """All frequent phrases of two to ``longest`` words, and the number of words per language.

    Phrases: lang, words (their number), key (the ids of the words), phrase, a, and the counts of its beginnings
    ``heads`` and ends ``tails``, by cut.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    chunks = materialise(texts.mapInArrow(_chunks(chunk), "chunk long, lang string, word array<string>, count array<long>, text binary"), "chunks")
    words = chunks.select("lang", F.explode(F.arrays_zip("word", "count")).alias("e"))
    counted = words.groupBy("lang", F.col("e.word").alias("word")).agg(F.sum("e.count").alias("a"))
    totals = chunks.select("lang", F.aggregate("count", F.lit(0).cast("bigint"), lambda s, c: s + c).alias("n"))
    totals = totals.groupBy("lang").agg(F.sum("n").alias("n"))
    none = F.array().cast("array<bigint>")
    ranked = _ranked(counted.filter(F.col("a") >= least), [F.col("lang"), F.col("a").desc(), F.col("word")], "words")
    known = ranked.select("lang", F.array("id").alias("key"), "a", F.col("word").alias("phrase"), F.col("word").alias("last"), none.alias("heads"), none.alias("tails"))
    places = chunks.select("chunk", "lang", F.posexplode("word").alias("place", "word"))
    entry = F.when(F.col("id").isNotNull(), F.struct(F.col("place").cast("bigint").alias("place"), "id"))
    # Merge joins at every size: whether the other side is small enough to broadcast must not change what is shuffled.
    named = places.join(ranked.select("lang", "word", "id").hint("merge"), ["lang", "word"], "left")
    dictionaries = named.groupBy("chunk").agg(F.collect_list(entry).alias("known"))
    chunks = materialise(chunks.select("chunk", "text").join(dictionaries.hint("merge"), "chunk").mapInArrow(_first_pairs, _COUNTED), "pairs")
    levels = []
    for size in range(2, longest + 1):
        names = _names(size)
        frequent = materialise(_sums(chunks, size, least), f"frequent-{size}")
        keyed = frequent.select("a", F.array(*names).alias("key"), F.array(*names[:-1]).alias("_one"), F.array(*names[1:]).alias("_two"))
        one = known.select(F.col("key").alias("_one"), "lang", F.col("phrase").alias("_first"), F.col("a").alias("_head"), "heads")
        two = known.select(F.col("key").alias("_two"), "last", F.col("a").alias("_tail"), "tails")
        full = keyed.join(one, "_one").join(two, "_two").select(
            "lang", "key", "a", "last", F.concat_ws(" ", "_first", "last").alias("phrase"),
            F.concat("heads", F.array("_head")).alias("heads"), F.concat(F.array("_tail"), "tails").alias("tails"),
        )
        known = materialise(full, f"phrases-{size}")
        levels.append(known.withColumn("words", F.lit(size)))
        if size < longest:
            chunks = materialise(chunks.mapInArrow(_longer(_bit_map(frequent, size, bits), bits), _COUNTED), f"pairs-{size + 1}")
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return every, totals


def collocations(
    docs: DataFrame, longest: int = 5, least: int = 100, share: int = 100, top: int = 2000, chunk: int = CHUNK, bits: int = BITS
) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase goes if a longer one that holds it has at least ``share`` percent of its count.
    """
    every, totals = phrases(docs, longest, least, chunk, bits)
    inner = F.array(F.slice("key", F.lit(1), F.col("words") - 1), F.slice("key", F.lit(2), F.col("words") - 1))
    longer = every.select(F.explode(inner).alias("key"), F.col("a").alias("longer")).groupBy("key").agg(F.max("longer").alias("longer"))
    held = F.coalesce(100 * F.col("longer") >= share * F.col("a"), F.lit(False))
    kept = every.join(longer, "key", "left").filter(~held).join(totals, "lang")
    scored = kept.select("lang", "phrase", "a", "n", F.expr(LOWEST_CUT).alias("cut")).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").cast("long").alias("score")
    )
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*best))).filter(F.col("_place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
