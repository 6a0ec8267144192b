"""Phrase collocations counted with broadcast double-array tries.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and
the pieces into words. Everything is per language. A phrase of ``k`` words is a
candidate only if its parts of ``k - 1`` words are frequent (Apriori), so
levels follow each other: words, then pairs, then triples.

1. A task turns its texts into shards: the distinct words of a few MB of text
   in one language, and the text as numbers of them. Word counts are summed by
   Spark; the frequent words get corpus-wide numbers, and each shard is written
   once more with those of its words.
2. Of a level, every shard adds its Apriori-safe places to a sketch, two rows of
   hashed counts that saturate. Places whose counts in the summed sketch are
   high enough in both rows (no frequent phrase is ever lost) give candidates.
3. The distinct candidates become double-array tries (base and check arrays
   over two digits of a trie's own number of each word), of about
   ``TRIE_PHRASES`` phrases at most, built in tasks. They are broadcast; numpy
   advances the states of all places of a shard through a trie at once, word by
   word, and bincounts the accepting states. Spark sums the counts of the tasks.

What is broadcast has a bound: a corpus of ``BROADCAST_WORDS`` words has a sketch
of at most 32 MB and no more frequent phrases than a tenth of its words. Beyond
that number of words the tries are not broadcast, and a level's places are
added up by Spark from the distinct phrases of each shard; the counts are the
same (tested).

A candidate is scored by its worst cut into two parts, ``a * a / (l * r)`` in
whole millionths, computed in decimals of 38 digits. Candidates inside a longer
one that is half as frequent or more are dropped, and each language's best are
ranked, in salted groups first.

Defined results: a null text is empty, a null language is ``und`` and the same
as a language of that name; an empty text has no word; repeated rows count as
often as they occur; an empty table gives an empty result. Words are compared
as bytes. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covtab.llm.common import written

#: Production parameters: least count of a candidate, most words, share of a
#: candidate's count (percent) that a longer one needs to replace it, rows a language.
LEAST = 10
LONGEST = 3
REPLACED_PERCENT = 50
TOP = 2000
#: Text in a shard, phrases in a trie, and words up to which tries are broadcast.
SHARD_BYTES = 8 << 20
TRIE_PHRASES = 1 << 18
BROADCAST_WORDS = 1 << 28
#: Digits of a word in a trie.
RADIX = 1024
#: Salted groups of the ranking.
SALTS = 64

# Characters that end a piece; they become the byte FF, which no UTF-8 text has.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_END = b"\xff"
_TABLE = bytes(0xFF if c in ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))

_WORDS = ["w1", "w2", "w3"]
_PHRASE = "lang string, w1 long, w2 long, w3 long"


# --- shards -----------------------------------------------------------------------

def encode(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of some texts, their counts, and the texts as numbers of words, -1 where a piece ends."""
    tokens = _END.join(t.translate(_TABLE) for t in texts).replace(_END, b" \xff ").split()
    coded = pa.array(tokens + [_END], pa.binary()).dictionary_encode()
    ids, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    end = words.index(_END)
    renumbered = np.arange(len(words), dtype=np.int32)
    renumbered[end + 1:] -= 1
    renumbered[end] = -1
    ids = renumbered[ids]
    del words[end]
    return words, np.bincount(ids[ids >= 0], minlength=len(words)), ids


def _packed(values: np.ndarray) -> bytes:
    """The numbers, byte by byte of their places: most high bytes are alike, and low ones compress among themselves."""
    raw = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _shards(docs: DataFrame, lang: str, text: str, shard_bytes: int) -> DataFrame:
    """``(shard, lang, words, counts, ids)``; a task holds the texts of four full shards at most."""
    pairs = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                        F.col(f"`{text}`").cast("string").cast("binary").alias("text")).where("text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def flush(name: str) -> Iterator[pa.RecordBatch]:
            words, counts, ids = encode(held.pop(name))
            del size[name]
            if words:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([words], pa.list_(pa.binary())), pa.array([counts], pa.list_(pa.int64())),
                     pa.array([_packed(ids.astype("<i4"))], pa.binary())], names=["lang", "words", "counts", "ids"])

        for batch in batches:
            for name, body in zip(batch.column("lang").to_pylist(), batch.column("text")):
                held.setdefault(name, []).append(body.as_py())
                size[name] = size.get(name, 0) + len(held[name][-1])
                if size[name] >= shard_bytes:
                    yield from flush(name)
                elif sum(size.values()) >= 4 * shard_bytes:
                    yield from flush(max(size, key=size.get))
        for name in list(held):
            yield from flush(name)

    found = pairs.mapInArrow(run, "lang string, words array<binary>, counts array<long>, ids binary")
    return written(found.withColumn("shard", F.monotonically_increasing_id()))


def _corpus(shards: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(lang, ids, keys)``: ``keys`` has the vocabulary's number of each word of a shard, 0 for a rare one."""
    words = shards.select("shard", "lang", F.size("words").alias("size"), F.posexplode("words").alias("at", "word"))
    found = words.join(vocabulary, ["lang", "word"]).select("shard", "size", "at", "id")

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        keys = np.zeros(table.column("size")[0].as_py(), np.int64)
        keys[table.column("at").to_numpy()] = table.column("id").to_numpy()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "keys": pa.array([_packed(keys)], pa.binary())})

    keys = found.groupBy("shard").applyInArrow(gather, "shard long, keys binary")
    # A given number of partitions is kept, so that later passes over the few bytes that are left of the texts use all cores.
    partitions = max(int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-shards.count() // 64))
    return written(shards.select("shard", "lang", "ids").repartition(partitions, "shard").join(
        keys.repartition(partitions, "shard"), "shard").drop("shard"))


class _Shard:
    """A shard's places: ``key`` has the corpus-wide number of the word of each, 0 for none."""

    def __init__(self, ids: bytes, keys: bytes):
        self.ids, self.keys = _unpacked(ids, "<i4"), _unpacked(keys, "<i8")
        self.key = np.append(self.keys, 0)[self.ids]

    def phrases(self, length: int, frequent: list[Trie] | None = None) -> tuple[np.ndarray, ...]:
        """The Apriori-safe phrases of each place: all words frequent and, given
        ``frequent``, all parts that are one word shorter."""
        n = max(self.key.size - length + 1, 0)
        if frequent is None:
            good = np.ones(n, bool)
            for k in range(length):
                good &= self.key[k:k + n] > 0
        else:
            starts = np.zeros(self.key.size, bool)
            for trie in frequent:
                starts[trie.advance(self)[0]] = True
            good = starts[:n] & starts[1:n + 1]
        at = np.flatnonzero(good)
        return tuple(self.key[at + k] for k in range(length))


def _shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Shard]]:
    for batch in batches:
        for lang, ids, keys in zip(*(batch.column(c) for c in ("lang", "ids", "keys"))):
            yield lang.as_py(), _Shard(ids.as_py(), keys.as_py())


def _distinct(phrase: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct phrases among those of all places, and how often each occurs."""
    order = np.lexsort(phrase[::-1])
    ordered = [w[order] for w in phrase]
    new = np.ones(order.size, bool)
    new[1:] = np.any([w[1:] != w[:-1] for w in ordered], axis=0)
    first = np.flatnonzero(new)
    return [w[first] for w in ordered], np.diff(np.append(first, order.size))


# --- sketches ---------------------------------------------------------------------

def _buckets(phrase: tuple[np.ndarray, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashed places of each phrase; word numbers differ between languages, so they need no mention."""
    x = np.zeros(phrase[0].size, np.uint64)
    for word in phrase:
        x = (x ^ word.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
    mask = np.uint64((1 << bits) - 1)
    return (x & mask).astype(np.int64), (x >> np.uint64(64 - bits)).astype(np.int64)


def _add(row: np.ndarray, places: np.ndarray, counts: np.ndarray) -> None:
    row[places] = np.minimum(row[places].astype(np.int64) + counts, 255)


def _sketch(corpus: DataFrame, length: int, frequent, bits: int) -> np.ndarray:
    """Two rows of ``2 ** bits`` counts, up to 255 each, over the places of all shards."""
    blocks = max(1, 2 << bits >> 16)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.zeros((2, 1 << bits), np.uint8)
        seen = False
        for lang, shard in _shards_of(batches):
            phrase = shard.phrases(length, _of_lang(frequent, lang))
            for row, places in zip(rows, _buckets(phrase, bits)):
                _add(row, *np.unique(places, return_counts=True))
            seen = True
        if seen:
            for number, block in enumerate(np.split(rows.ravel(), blocks)):
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([_packed(block)], pa.binary())], ["block", "data"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                block = _unpacked(data.as_py(), np.uint8)
                before = sums.get(number)
                sums[number] = block if before is None else np.minimum(before.astype(np.int16) + block, 255).astype(np.uint8)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(map(_packed, sums.values()), pa.binary())],
                                             ["block", "data"])

    schema = "block int, data binary"
    summed = corpus.mapInArrow(count, schema).repartition("block").mapInArrow(add_up, schema)
    out = np.zeros((blocks, (2 << bits) // blocks), np.uint8)
    for row in summed.collect():  # 2 ** (bits + 1) bytes at most
        out[row.block] = _unpacked(bytes(row.data), np.uint8)
    return out.reshape(2, -1)


# --- tries ------------------------------------------------------------------------

class Trie:
    """A double-array trie of phrases of one length. A word is its number in
    ``symbols``, walked in two digits; the child of state ``s`` by digit ``d``
    is ``base[s] + d`` if ``check`` there is ``s``."""

    def __init__(self, symbols: np.ndarray, base: np.ndarray, check: np.ndarray, length: int):
        self.symbols, self.base, self.check, self.length = symbols, base, check, length

    def advance(self, shard: _Shard) -> tuple[np.ndarray, np.ndarray]:
        """Places where a phrase starts, and the accepting state of each: the
        states of all places go on by one word at a time."""
        at = np.minimum(np.searchsorted(self.symbols, shard.keys), self.symbols.size - 1)
        code = np.append(np.where(self.symbols[at] == shard.keys, at, -1), -1)[shard.ids]
        place = np.flatnonzero(code >= 0)
        state = np.zeros(place.size, np.int64)
        for k in range(self.length):
            word = code[np.minimum(place + k, code.size - 1)]
            known = (word >= 0) & (place + k < code.size)
            place, state, word = place[known], state[known], word[known]
            for first in (True, False):
                child = self.base[state] + (word // RADIX if first else word % RADIX)
                goes = self.check[child] == state
                place, state, word = place[goes], child[goes], word[goes]
        return place, state

    def words(self, state: np.ndarray) -> list[np.ndarray]:
        """The words that lead to states, read back from the arrays."""
        out = []
        for _ in range(self.length):
            code = np.zeros(state.size, np.int64)
            for weight in (1, RADIX):
                parent = self.check[state].astype(np.int64)
                code += weight * (state - self.base[parent])
                state = parent
            out.append(self.symbols[code])
        return out[::-1]


def build(phrases: np.ndarray) -> Trie:
    """The trie of phrases (rows of word numbers, distinct, under ``RADIX ** 2`` words)."""
    symbols, codes = np.unique(phrases, return_inverse=True)
    codes = codes.reshape(phrases.shape)
    digits = np.stack([codes // RADIX, codes % RADIX], axis=2).reshape(len(phrases), -1)
    digits = digits[np.lexsort(digits.T[::-1])]
    slots = _Slots()
    state = np.zeros(len(digits), np.int64)
    for k in range(digits.shape[1]):
        new = np.ones(len(digits), bool)  # the distinct (state, digit) pairs, in order
        new[1:] = (state[1:] != state[:-1]) | (digits[1:, k] != digits[:-1, k])
        state = slots.place(state[new], digits[new, k])[np.cumsum(new) - 1]
    end = slots.end + RADIX  # every sum of a base and a digit is a place
    slots.grow(end)
    return Trie(symbols, slots.base[:end], slots.check[:end], phrases.shape[1])


class _Slots:
    """The two arrays while they are filled."""

    WINDOW = 4096

    def __init__(self):
        self.base, self.check = np.zeros(self.WINDOW, np.int64), np.full(self.WINDOW, -1, np.int64)
        self.used = np.zeros(self.WINDOW, bool)
        self.used[:RADIX] = True  # a base is positive, and the root is state 0
        self.free = np.array([self.WINDOW - RADIX])  # by window
        self.end = RADIX

    def grow(self, size: int) -> None:
        if size > self.used.size:
            more = -(-max(size, 2 * self.used.size) // self.WINDOW) * self.WINDOW - self.used.size
            self.base, self.used = np.pad(self.base, (0, more)), np.pad(self.used, (0, more))
            self.check = np.pad(self.check, (0, more), constant_values=-1)
            self.free = np.pad(self.free, (0, more // self.WINDOW), constant_values=self.WINDOW)

    def _take(self, slots: np.ndarray) -> None:
        self.used[slots] = True
        np.subtract.at(self.free, slots // self.WINDOW, 1)
        self.end = max(self.end, int(slots[-1]) + 1)

    def _fit(self, gaps: np.ndarray) -> int:
        """A slot from which ``gaps`` on all are free, in the windows where one is likely; else at the end."""
        last = -(-self.end // self.WINDOW)
        likely = np.flatnonzero(self.free[:last] * (self.free[:last] / self.WINDOW) ** (gaps.size - 1) >= 1)
        for window in likely[:4].tolist():
            at = np.flatnonzero(~self.used[window * self.WINDOW:(window + 1) * self.WINDOW]) + window * self.WINDOW
            for gap in gaps[1:]:
                at = at[~self.used[at + gap]]
                if not at.size:
                    break
            if at.size:
                return int(at[0])
        return self.end

    def place(self, parents: np.ndarray, children: np.ndarray) -> np.ndarray:
        """Slots for children (digits, in order, grouped by parent): large groups
        first, and single children into what is left."""
        starts = np.flatnonzero(np.concatenate(([True], parents[1:] != parents[:-1])))
        sizes = np.diff(np.append(starts, parents.size))
        out = np.zeros(parents.size, np.int64)
        many = np.flatnonzero(sizes > 1)
        for group in many[np.argsort(-sizes[many], kind="stable")].tolist():
            i, j = starts[group], starts[group] + sizes[group]
            gaps = children[i:j] - children[i]
            self.grow(self.end + self.WINDOW + 2 * RADIX)
            out[i:j] = self._fit(gaps) + gaps
            self._take(out[i:j])
        single = starts[sizes == 1]
        if single.size:
            self.grow(self.end + single.size)
            free = np.flatnonzero(~self.used[:self.end + single.size])[:single.size]
            out[single] = free
            self._take(free)
        self.check[out] = parents
        self.base[parents] = out - children
        return out


def _of_lang(tries, lang: str) -> list[Trie] | None:
    """The broadcast tries of a language, or None where none are asked for."""
    return None if tries is None else tries.value.get(lang, [])


def _tries(phrases: DataFrame, length: int, trie_phrases: int):
    """Broadcasts ``{lang: tries}`` of a written table of distinct phrases."""
    # As many parts for each language as all phrases need, so that no language is gathered to be counted.
    parts = max(-(-phrases.count() // trie_phrases), 1)
    dealt = phrases.withColumn("part", F.pmod(F.xxhash64("w1", "w2"), F.lit(parts)).cast("int"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        trie = build(np.stack([table.column(c).to_numpy() for c in _WORDS[:length]], axis=1))
        arrays = [_packed(a.astype("<i8" if k == 0 else "<i4")) for k, a in enumerate((trie.symbols, trie.base, trie.check))]
        return pa.table({"lang": pa.array([key[0].as_py()], pa.string()),
                         **{c: pa.array([a], pa.binary()) for c, a in zip(("symbols", "base", "check"), arrays)}})

    out: dict[str, list[Trie]] = {}
    for row in dealt.groupBy("lang", "part").applyInArrow(run, "lang string, symbols binary, base binary, check binary").collect():
        arrays = _unpacked(bytes(row.symbols), "<i8"), _unpacked(bytes(row.base), "<i4"), _unpacked(bytes(row.check), "<i4")
        out.setdefault(row.lang, []).append(Trie(*arrays, length))
    return phrases.sparkSession.sparkContext.broadcast(out)


# --- levels -----------------------------------------------------------------------

def _rows(lang: str, words: list[np.ndarray], counts: np.ndarray | None = None) -> pa.RecordBatch:
    n = words[0].size
    columns = [*words, *[np.zeros(n, np.int64)] * (LONGEST - len(words))] + ([] if counts is None else [counts])
    return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), *(pa.array(c.astype(np.int64)) for c in columns)],
                                      ["lang", *_WORDS, *(["n"] if counts is not None else [])])


def _candidates(corpus: DataFrame, length: int, frequent, sketch, bits: int, least: int) -> DataFrame:
    """The distinct phrases that may occur ``least`` times (of at most 255)."""
    floor = min(least, 255)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, shard in _shards_of(batches):
            phrase = shard.phrases(length, _of_lang(frequent, lang))
            one, two = _buckets(phrase, bits)
            good = (sketch.value[0][one] >= floor) & (sketch.value[1][two] >= floor)
            yield _rows(lang, _distinct([w[good] for w in phrase])[0])

    return written(corpus.mapInArrow(run, _PHRASE).distinct())


def _counted(corpus: DataFrame, tries) -> DataFrame:
    """How often the phrases of the tries occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[np.ndarray]] = {}
        for lang, shard in _shards_of(batches):
            own = tries.value.get(lang, [])
            totals = sums.setdefault(lang, [np.zeros(t.check.size, np.int64) for t in own])
            for total, trie in zip(totals, own):
                total += np.bincount(trie.advance(shard)[1], minlength=total.size)
        for lang, totals in sums.items():
            for total, trie in zip(totals, tries.value.get(lang, [])):
                state = np.flatnonzero(total)
                yield _rows(lang, trie.words(state), total[state])

    return corpus.mapInArrow(run, f"{_PHRASE}, n long")


def _added_up(corpus: DataFrame, length: int) -> DataFrame:
    """How often each phrase of frequent words occurs in each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, shard in _shards_of(batches):
            yield _rows(lang, *_distinct(list(shard.phrases(length))))

    return corpus.mapInArrow(run, f"{_PHRASE}, n long")


def _level(corpus: DataFrame, length: int, shorter: DataFrame | None, words: int, least: int, broadcast_words: int,
           trie_phrases: int) -> DataFrame:
    """``(lang, w1, w2, w3, a)`` of the phrases of ``length`` words that occur ``least`` times or more."""
    context = corpus.sparkSession.sparkContext
    if words > broadcast_words:
        counted = _added_up(corpus, length)
    else:
        bits = max(10, (words // 16).bit_length())
        frequent = _tries(shorter.drop("a"), length - 1, trie_phrases) if shorter is not None else None
        sketch = context.broadcast(_sketch(corpus, length, frequent, bits))
        found = _candidates(corpus, length, frequent, sketch, bits, least)
        counted = _counted(corpus, _tries(found, length, trie_phrases))
    return written(counted.groupBy("lang", *_WORDS).agg(F.sum("n").alias("a")).where(F.col("a") >= least))


# --- scores -----------------------------------------------------------------------

def _score(left: str, right: str) -> str:
    exact = lambda c: f"CAST({c} AS DECIMAL(14,0))"
    return f"(1000000BD * {exact('a')} * {exact('a')}) div ({exact(left)} * {exact(right)})"


def _named(phrases: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``phrases`` with the word and count (``n1`` ...) of each place."""
    for k, column in enumerate(_WORDS, 1):
        phrases = phrases.join(vocabulary.select(F.col("id").alias(column), F.col("word").alias(f"word{k}"), F.col("n").alias(f"n{k}")),
                               column, "left")
    return phrases


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP,
                 shard_bytes: int = SHARD_BYTES, broadcast_words: int = BROADCAST_WORDS, trie_phrases: int = TRIE_PHRASES) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's best phrases of two and three words."""
    shards = _shards(docs, lang, text, shard_bytes)
    counts = shards.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).groupBy(
        "lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("n"))
    # Numbered once written, from 1; the numbers of two languages differ.
    vocabulary = written(counts.where(F.col("n") >= least).withColumn("id", F.monotonically_increasing_id() + 1))
    sizes = shards.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda t, x: t + x)).alias("n"))
    words = sizes.agg(F.sum("n")).first()[0] or 0
    corpus = _corpus(shards, vocabulary.select("lang", "word", "id"))
    pairs = _level(corpus, 2, None, words, least, broadcast_words, trie_phrases)
    triples = _level(corpus, 3, pairs, words, least, broadcast_words, trie_phrases)

    inside = triples.select("w1", "w2", "a").union(triples.select("w2", "w3", "a")).toDF("w1", "w2", "longer").groupBy("w1", "w2").agg(
        F.max("longer").alias("longer"))
    two = pairs.join(inside, ["w1", "w2"], "left").where(
        F.coalesce(100 * F.col("longer") < REPLACED_PERCENT * F.col("a"), F.lit(True))).drop("longer")
    two = _named(two, vocabulary).select("lang", "a", F.col("n1").alias("l"), F.col("n2").alias("r"), "word1", "word2", "word3").withColumn(
        "score", F.expr(_score("l", "r")))
    three = _named(triples, vocabulary)
    three = three.join(pairs.selectExpr("w1", "w2", "a AS head"), ["w1", "w2"]).join(
        pairs.selectExpr("w1 AS w2", "w2 AS w3", "a AS tail"), ["w2", "w3"])
    three = three.withColumns({"s1": F.expr(_score("n1", "tail")), "s2": F.expr(_score("head", "n3"))}).selectExpr(
        "lang", "a", "CASE WHEN s1 <= s2 THEN n1 ELSE head END AS l", "CASE WHEN s1 <= s2 THEN tail ELSE n3 END AS r",
        "word1", "word2", "word3", "least(s1, s2) AS score")
    scored = two.unionByName(three).withColumn(
        "phrase", F.concat_ws(" ", *[F.col(f"word{k}").cast("string") for k in (1, 2, 3)])).select("lang", "phrase", "a", "l", "r", "score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
