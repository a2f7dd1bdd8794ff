"""Phrase collocations, counted in weighted acyclic automata.

Each task turns its texts into shards, and a shard's sorted n-grams into count
transducers, one per range of the n-grams' order. The transducers of a range are united
and their weights summed. This is done for one word, then two, then three; a longer
phrase is counted only if its parts are frequent, which a bitmap of fixed size tells.
Candidates then ask for the counts of their parts: what a range of candidates needs is an
automaton of its own, composed with the transducer of the range that knows the counts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyloom.llm.common import col, cut
from keyloom.llm.count_automata import CountTransducer, build, by_range, union

# What ends a piece, and what separates words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
NO_LANG = "und"

_TABLE = bytes(ord(".") if b in PIECE_ENDS else ord(" ") if b in BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_SLICE = 1 << 20  # bytes of a text that are split at a time
_SHARD = 1_500_000  # words that a task counts before it hands on transducers
_RANGE = 1_500_000  # words of the corpus to a range, about
_MOST_RANGES = 100_000
_SAMPLE_DOCS, _SAMPLE_GRAMS = 2_000, 50  # about so many documents place the bounds, with at most so many n-grams each
_FILTER_BITS = 26  # a bitmap of 2**26 bits: 8 MB
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)

_SHARDS = "range int, automaton binary"
_COUNTED = "words int, range int, automaton binary, langs array<string>, totals array<bigint>, bits array<bigint>"


def pieces_of(text: str | None) -> Iterator[list[bytes]]:
    """The words of ``text`` in slices, A-Z in lower case; a word ``.`` ends a piece."""
    data = (text or "").encode("utf-8", "replace").translate(_TABLE)
    at = 0
    while at < len(data):
        end = at + _SLICE
        if end < len(data):
            end = max(data.rfind(b" ", at, end), 0) or data.find(b" ", end)
        end = len(data) if end < 0 else end
        yield data[at:end].replace(b".", b" . ").split()
        at = end + 1


def _hashes(symbols: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(s) for s in symbols], dtype=np.uint64)


def _bits(columns: list[np.ndarray]) -> np.ndarray:
    """Places in the bitmap of paths, given by the hashes of their symbols."""
    mixed = columns[0] * _ODD[0]
    for i, c in enumerate(columns[1:]):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _ODD[1] + c * _ODD[2 + i % 3]
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * _ODD[1]) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def _is_set(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


class Shard:
    """Counts n-grams of ``words`` words per language; of longer ones those whose parts of one word less are in ``bitmap``."""

    def __init__(self, words: int, bitmap: np.ndarray | None):
        self.words, self.bitmap = words, bitmap
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.numbers[b"."]
        self.read: dict[bytes, list[np.ndarray]] = defaultdict(list)
        self.n_words = 0

    def add(self, lang: bytes, text: str | None) -> None:
        held = self.read[lang]
        for tokens in pieces_of(text):
            held.append(np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens)))
            self.n_words += len(tokens)
        held.append(np.zeros(1, dtype=np.int32))

    def counted(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Ascending paths of language and words, their counts, and the ascending symbols."""
        words = list(self.numbers)
        symbols = sorted({*words[1:], *self.read})
        place = {s: i for i, s in enumerate(symbols)}
        rank = np.array([-1, *(place[w] for w in words[1:])], dtype=np.int64)
        hashed = _hashes(symbols) if self.bitmap is not None else None
        paths, counts = [], []
        for lang in sorted(self.read):
            found, n = self._grams(rank[np.concatenate(self.read[lang])], place[lang], len(symbols), hashed)
            paths.append(np.column_stack([np.full(len(found), place[lang]), found]).astype(np.int32))
            counts.append(n)
        return np.concatenate(paths), np.concatenate(counts), symbols

    def _grams(self, at: np.ndarray, lang: int, width: int, hashed: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        n = self.words
        size = max(len(at) - n + 1, 0)
        parts = [at[i : i + size] for i in range(n)]
        good = np.ones(size, dtype=bool)
        for p in parts:
            good &= p >= 0
        if self.bitmap is not None:
            for shift in range(2):  # the parts without the last and without the first word
                part = [hashed[np.maximum(p, 0)] for p in parts[shift : shift + n - 1]]
                good &= _is_set(self.bitmap, _bits([np.full(size, hashed[lang]), *part]))
        parts = [p[good] for p in parts]
        if n == 1:
            counts = np.bincount(parts[0], minlength=width)
            found = np.flatnonzero(counts)
            return found[:, None], counts[found]
        if width**n >= 1 << 62:  # too wide for one integer
            return np.unique(np.column_stack(parts), axis=0, return_counts=True)
        key = parts[0]
        for p in parts[1:]:
            key = key * width + p
        key, counts = np.unique(key, return_counts=True)
        columns = []
        for _ in parts:
            key, last = np.divmod(key, width)
            columns.insert(0, last)
        return np.column_stack(columns), counts

    def automata(self, bounds: list[tuple[bytes, ...]]) -> Iterator[tuple[int, bytes]]:
        """The range and the transducer of each range that the shard has n-grams of."""
        if self.read:
            paths, counts, symbols = self.counted()
            self.clear()
            for number, s, e in by_range(paths, symbols, bounds):
                yield number, build(paths[s:e], counts[s:e], symbols).to_bytes()


def _batch(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], [n for n, _ in kinds])


def _table(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, kinds)])


def _bounds(docs: DataFrame, most_words: int) -> list[list[tuple[bytes, ...]]]:
    """For phrases of 1, 2, ... words the least path of each range but the first.

    Taken from n-grams of a sample of the documents, at most about 100,000. They place the work,
    and have no part in the result.
    """
    n_docs = docs.count()
    fraction = min(1.0, _SAMPLE_DOCS / max(n_docs, 1))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = [t for part in pieces_of(text) for t in part]
                step = max(1, len(tokens) // _SAMPLE_GRAMS)
                grams = [[lang.encode(), *tokens[i : i + most_words]] for i in range(0, len(tokens), step)]
                rows.append((len(tokens), grams))
            yield _batch(rows, [("n", pa.int64()), ("grams", pa.list_(pa.list_(pa.binary())))])

    drawn = docs.sample(fraction, seed=11).mapInArrow(sampled, "n bigint, grams array<array<binary>>").toArrow()
    grams = sorted(tuple(map(bytes, g)) for row in drawn.column("grams").to_pylist() for g in row if b"." not in g)
    words = sum(drawn.column("n").to_pylist()) / fraction
    ranges = max(1, min(_MOST_RANGES, round(words / _RANGE)))
    chosen = [grams[i * len(grams) // ranges] for i in range(1, ranges)] if grams else []
    return [[path for path, _ in groupby(g[: n + 1] for g in chosen)] for n in range(1, most_words + 1)]


def _level(docs: DataFrame, words: int, bitmap: np.ndarray | None, bounds: list[tuple[bytes, ...]], least: int) -> DataFrame:
    """Per range the transducer of all phrases of ``words`` words found ``least`` times or more, and their places in the bitmap."""
    context = docs.sparkSession.sparkContext
    sent = context.broadcast((bitmap, bounds))  # 8 MB, and at most 100,000 bounds

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(words, sent.value[0])

        def handed_on():
            for row in shard.automata(sent.value[1]):
                yield _batch([row], [("range", pa.int32()), ("automaton", pa.binary())])

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                shard.add(lang.as_py().encode(), text.as_py())
                if shard.n_words >= _SHARD:
                    yield from handed_on()
        yield from handed_on()

    def united(group: pa.Table) -> pa.Table:
        found = map(CountTransducer.from_bytes, group.column("automaton").to_pylist())
        paths, counts, symbols = union(list(found))
        langs, at = np.unique(paths[:, 0], return_inverse=True)
        totals = np.zeros(len(langs), dtype=np.int64)
        np.add.at(totals, at, counts)
        frequent = counts >= least
        paths, counts = paths[frequent], counts[frequent]
        hashed = _hashes(symbols)
        bits = np.unique(_bits([hashed[paths[:, i]] for i in range(words + 1)]))
        names = [symbols[i].decode() for i in langs.tolist()]
        blob = build(paths, counts, symbols).to_bytes() if len(paths) else None
        return _table([(words, group.column("range")[0].as_py(), blob, names, totals.tolist(), bits.tolist())], _COUNTED_KINDS)

    return cut(docs.mapInArrow(shards, _SHARDS).groupBy("range").applyInArrow(united, _COUNTED))


_COUNTED_KINDS = [("words", pa.int32()), ("range", pa.int32()), ("automaton", pa.binary()), ("langs", pa.list_(pa.string())), ("totals", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))]


def _bitmap(counted: DataFrame) -> np.ndarray:
    """The bits of all ranges in one bitmap: 2048 rows of 4 KB at most."""
    bits = counted.select(F.explode("bits").alias("at"))
    parts = bits.groupBy(F.shiftright("at", 15).alias("part")).agg(F.expr("bitmap_construct_agg(at & 32767)").alias("bitmap")).toArrow()
    found = np.zeros(1 << (_FILTER_BITS - 3), dtype=np.uint8)
    for part, bitmap in zip(parts.column(0).to_pylist(), parts.column(1).to_pylist(), strict=True):
        found[part << 12 : (part + 1) << 12] = np.frombuffer(bitmap, np.uint8)
    return found


_ASKED = [("words", pa.int32()), ("range", pa.int32()), ("from_words", pa.int32()), ("from_range", pa.int32()), ("automaton", pa.binary())]


def _part_counts(candidates: DataFrame, counted: DataFrame, bounds: list[list[tuple[bytes, ...]]]) -> DataFrame:
    """``from_words, from_range, words`` and a transducer: the parts that a range of candidates needs, with their counts."""
    sent = candidates.sparkSession.sparkContext.broadcast(bounds)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, number, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = CountTransducer.from_bytes(blob)
                paths, _ = found.paths()
                for n in range(1, words):
                    parts = np.concatenate([paths[:, [0, *range(1, n + 1)]], paths[:, [0, *range(words - n + 1, words + 1)]]])
                    parts = np.unique(parts, axis=0)
                    for to, s, e in by_range(parts, found.symbols, sent.value[n - 1]):
                        asked = build(parts[s:e], np.zeros(e - s, dtype=np.int64), found.symbols)
                        yield _batch([(n, to, words, number, asked.to_bytes())], _ASKED)

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        rows = []
        counts = CountTransducer.from_bytes(known.column("automaton")[0].as_py()) if known.num_rows else None
        for row in asked.to_pylist():
            parts = CountTransducer.from_bytes(row["automaton"])
            paths, _ = parts.paths()
            told = build(paths, counts.compose(parts), parts.symbols)
            rows.append((row["words"], row["range"], row["from_words"], row["from_range"], told.to_bytes()))
        return _table(rows, _ASKED)

    schema = "words int, range int, from_words int, from_range int, automaton binary"
    asked = candidates.select("words", "range", "automaton").mapInArrow(ask, schema)
    known = counted.select("words", "range", "automaton")
    return asked.groupBy("words", "range").cogroup(known.groupBy("words", "range")).applyInArrow(answer, schema)


_SCORED = [("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("a", pa.int64()), ("l", pa.int64()), ("r", pa.int64()), ("score", pa.int64()), ("inside", pa.list_(pa.string()))]


def _scored(told: pa.Table, candidates: pa.Table) -> pa.Table:
    """Score of each candidate of a range: its lowest-scoring cut, of equals the first."""
    part = {}
    for blob in told.column("automaton").to_pylist():
        found = CountTransducer.from_bytes(blob)
        paths, counts = found.paths()
        part.update(zip((tuple(found.symbols[i] for i in p) for p in paths.tolist()), counts.tolist(), strict=True))
    rows = []
    for blob in candidates.column("automaton").to_pylist():
        found = CountTransducer.from_bytes(blob)
        for path, a in zip(*(x.tolist() for x in found.paths()), strict=True):
            lang, *words = (found.symbols[i] for i in path)
            cuts = [(part[(lang, *words[:k])], part[(lang, *words[k:])]) for k in range(1, len(words))]
            score, k = min((1_000_000 * a * a // (left * right), k) for k, (left, right) in enumerate(cuts))
            inside = [b" ".join(words[i : i + n]).decode() for n in range(2, len(words)) for i in range(len(words) - n + 1)]
            rows.append((lang.decode(), b" ".join(words).decode(), len(words), a, *cuts[k], score, inside))
    return _table(rows, _SCORED)


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", most_words: int = 3, least: int = 10, inside_percent: int = 50, top: int = 2000) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts, A-Z in lower case, are split at ``.,;:!?`` and line ends into pieces, those at blanks
    and tabs into words. A phrase of 2 to ``most_words`` words found ``least`` times or more is a
    candidate; ``a`` counts it, ``l`` and ``r`` the two parts at the cut whose score
    1000000 a a / (l r), rounded down, is lowest, ``n`` all words of the language. A phrase inside a
    longer candidate that has ``inside_percent`` of its count is left out. Equal scores are in order
    of count, then of the phrase's bytes; repeated rows count as often as they occur.

    Null and empty texts have no words; a null language is ``und``. Texts of any length are split in
    slices of 1 MB at blanks; a word is held whole. Other columns of ``df``, whatever their
    names, play no part. An empty table, or one without a candidate, gives no rows.

    Every count is exact. A word with a large share of all n-grams starts many
    ranges, as these are cut inside its phrases too; a phrase with a large share is
    one entry per shard. What a task holds is bounded by the shard, a range, and the bitmap of 8 MB. On a
    corpus with far more frequent phrases than bits the bitmap spares less, and nothing else changes.
    """
    docs = df.select(F.coalesce(col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), col(text).alias("text"))
    bounds = _bounds(docs, most_words)
    levels: list[DataFrame] = []
    for words in range(1, most_words + 1):
        bitmap = _bitmap(levels[-1]) if levels else None
        levels.append(_level(docs, words, bitmap, bounds[words - 1], least))
    totals = levels[0].select(F.inline(F.arrays_zip("langs", "totals"))).groupBy(F.col("langs").alias("lang")).agg(F.sum("totals").alias("n"))

    counted = levels[0]
    for level in levels[1:]:
        counted = counted.unionByName(level)
    counted = counted.where("automaton is not null")
    candidates = counted.where("words > 1")
    told = _part_counts(candidates, counted, bounds)
    scored = cut(
        told.select(F.col("from_words").alias("words"), F.col("from_range").alias("range"), "automaton")
        .groupBy("words", "range")
        .cogroup(candidates.select("words", "range", "automaton").groupBy("words", "range"))
        .applyInArrow(_scored, "lang string, phrase string, words int, a bigint, l bigint, r bigint, score bigint, inside array<string>")
    )
    longer = scored.select("lang", F.col("a").alias("outer"), F.explode("inside").alias("phrase")).groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    kept = scored.drop("inside").join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("outer") < inside_percent * F.col("a"), F.lit(True)))

    # First within 64 parts of a language, so that one with very many phrases is not ranked in one task.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
