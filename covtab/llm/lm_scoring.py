"""Language-model scoring by cross-entropy difference.

Two bigram models are counted: the target model over the documents that
``target`` names, the background model over all documents. They are matched:
one vocabulary (words that the target has ``MIN_COUNT`` times or more, one
unknown word, the end of a document), one smoothing, and background counts
scaled to the target's number of tokens. A document's score is the mean over
its tokens, its end included, of the loss under the target model less the loss
under the background model; low scores look like the target. A document's own
counts are left out of the models that score it, or it would vouch for itself.

    P1(w)   = (c(w) + ALPHA) / (N + ALPHA * K)
    P(w|v)  = (c(v, w) + MU * P1(w)) / (c(v) + MU)

Counts cover the whole corpus and no table of them is ever in one place. Each
shard of documents sends its distinct words, then its distinct bigrams, with
their counts to ranges of their hashes and gets the sums back; a word that
all documents share is one entry of a shard. So a task holds a shard or a
range, and everything grows with the corpus. Shards are of id and text
together; identical rows are one entry with their number.

Defined results: a null text has no words; a document without words is scored
on its end alone; a null id is never a target; repeated rows are documents of
their own, each of them a target if the id is; without targets all scores are
zero. An empty table gives an empty result. Other columns, whatever their
names, play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covtab.llm.common import chunks_of_copies, cut_lineage, merged, shard_count, shard_of, sharded, with_copies
from covtab.llm.exchange import ROWS, answers_of, pack, rows_of, sent, unpack, word_hashes

#: Production parameters.
MIN_COUNT = 2
ALPHA = 0.5
MU = 4.0
#: Text in a shard (two tasks of 600 MB hold it with all its arrays; larger
#: executors take larger shards, of which fewer rows are exchanged), and hash
#: bits of a bigram.
SHARD_BYTES = 8 << 20
PAIR_BITS = 56

_START, _END, _UNKNOWN = np.uint64(1), np.uint64(2), np.uint64(3)
_WORDS, _NOTE, _PAIRS = 1, 2, 3


def _counts(keys: np.ndarray, copies: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, the number of each place's key, and counts in all and in
    target places, a place counting as often as its document has copies."""
    distinct, number = np.unique(keys, return_inverse=True)
    return (distinct, number, np.bincount(number, weights=copies, minlength=distinct.size).astype(np.uint64),
            np.bincount(number, weights=copies * target, minlength=distinct.size).astype(np.uint64))


class Shard:
    """The distinct documents of a shard in a fixed order, as one sequence of tokens."""

    def __init__(self, table: pa.Table):
        named = table.filter(pc.field("is_target")).column("doc_id")
        docs = merged(table.filter(~pc.field("is_target")))
        self.ids = docs.column("doc_id")
        hashes, sizes = [], []
        for text in docs.column("text"):
            words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()  # bytes split at the six spaces only
            sizes.append(len(words) + 1)
            if words:
                hashes.append(np.maximum(word_hashes(words), np.uint64(4)))
            hashes.append(np.array([_END]))
        self.tokens = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.sizes = np.array(sizes, dtype=np.int64)
        self.doc = np.repeat(np.arange(self.sizes.size), self.sizes)
        self.times = docs.column("copies").to_numpy()
        self.copies = self.times[self.doc].astype(float)
        self.is_target = np.array(pc.is_in(self.ids, value_set=named.combine_chunks().drop_null()).to_pylist(), dtype=bool)
        self.target = self.is_target[self.doc].astype(float)
        self.first = np.cumsum(self.sizes) - self.sizes

    def own(self, keys: np.ndarray) -> np.ndarray:
        """How often the key of each place stands in its document."""
        order = np.lexsort((keys, self.doc))
        new = np.ones(keys.size, dtype=bool)
        new[1:] = (keys[order][1:] != keys[order][:-1]) | (self.doc[order][1:] != self.doc[order][:-1])
        number = np.cumsum(new) - 1
        out = np.empty(keys.size)
        out[order] = np.bincount(number)[number] if keys.size else 0
        return out


@dataclass
class Vocabulary:
    """What a shard knows of its words: the mapped tokens and the corpus counts of each place."""

    mapped: np.ndarray
    everywhere: np.ndarray
    in_target: np.ndarray
    size: float
    all_tokens: float
    target_tokens: float
    documents: float
    target_documents: float


def _totals(keys: np.ndarray, everywhere: np.ndarray, in_target: np.ndarray) -> np.ndarray:
    """Of a range: words of the vocabulary, their tokens, all tokens, documents (in all and in target)."""
    known = (in_target >= MIN_COUNT) | (keys == _END)
    end = keys == _END
    return np.array([known.sum(), everywhere[known].sum(), in_target[known].sum(), everywhere.sum(), in_target.sum(),
                     everywhere[end].sum(), in_target[end].sum()], dtype=np.uint64)


def _vocabulary(shard: Shard, counts: bytes, totals: np.ndarray) -> Vocabulary:
    everywhere, in_target = (c.astype(float) for c in unpack(counts, 2)) if counts else (np.zeros(0), np.zeros(0))
    distinct, number = np.unique(shard.tokens, return_inverse=True)
    known = (in_target >= MIN_COUNT) | (distinct == _END)
    size, known_all, known_target, tokens, target_tokens, documents, target_documents = totals.astype(float).tolist()
    everywhere, in_target = np.where(known, everywhere, tokens - known_all), np.where(known, in_target, target_tokens - known_target)
    return Vocabulary(np.where(known, distinct, _UNKNOWN)[number], everywhere[number], in_target[number],
                      size + 1, tokens, target_tokens, documents, target_documents)


def _before(shard: Shard, values: np.ndarray, start: float | np.uint64) -> np.ndarray:
    """The value of the token before each, ``start`` for the first of a document."""
    out = np.roll(values, 1)
    out[shard.first] = start
    return out


def _pairs(shard: Shard, words: Vocabulary) -> np.ndarray:
    x = _before(shard, words.mapped, _START) * np.uint64(0x9E3779B97F4A7C15) + words.mapped
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(32))) >> np.uint64(64 - PAIR_BITS)


def _losses(shard: Shard, words: Vocabulary, pairs: np.ndarray, everywhere: np.ndarray, in_target: np.ndarray) -> list[np.ndarray]:
    """Loss of each token under the target and the background model."""
    own_word, own_pair = shard.own(words.mapped), shard.own(pairs)
    own_before, n = _before(shard, own_word, 1.0), shard.sizes[shard.doc].astype(float)
    scale = words.target_tokens / words.all_tokens if words.all_tokens else 0.0
    out = []
    for times, left_out, word, pair, start, tokens in (
            (1.0, shard.target, words.in_target, in_target, words.target_documents, words.target_tokens),
            (scale, np.ones(pairs.size), words.everywhere, everywhere, words.documents, words.all_tokens)):
        one = (times * (word - left_out * own_word) + ALPHA) / (times * (tokens - left_out * n) + ALPHA * words.size)
        before = times * (_before(shard, word, start) - left_out * own_before)
        out.append(-np.log((times * (pair - left_out * own_pair) + MU * one) / (before + MU)))
    return out


def _sums(bucket: tuple, table: pa.Table) -> pa.Table:
    """The counts of one range of keys, added up over the shards; notes are passed on."""
    rows, parts, level = [], [], 0
    for shard, at, data in zip(*(table.column(c).to_pylist() for c in ("shard", "level", "data"))):
        if at == _NOTE:
            rows.append((bucket[0].as_py(), shard, at, data))
        else:
            level = at
            steps, *counts = unpack(data, 3)
            parts.append((shard, np.cumsum(steps), *counts))
    if parts:
        shards, keys, everywhere, in_target = zip(*parts)
        ends = np.cumsum([k.size for k in keys])[:-1]
        distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
        add = lambda c: np.bincount(number, weights=np.concatenate(c).astype(float), minlength=distinct.size).astype(np.uint64)
        everywhere, in_target = add(everywhere), add(in_target)
        totals = _totals(distinct, everywhere, in_target).tobytes() if level == _WORDS else b""
        for shard, places in zip(shards, np.split(number, ends)):
            rows.append((bucket[0].as_py(), shard, level, totals + pack(everywhere[places], in_target[places])))
    return rows_of(rows)


def _joined(answers: list[tuple[int, bytes]], skip: int = 0) -> list[np.ndarray]:
    parts = [unpack(data[skip:], 2) for _, data in answers]
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.uint64)] * 2


def score(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_tokens``, mean
    ``target_loss`` and ``background_loss`` in nats, and their ``difference``.
    ``target`` has the ids of the target documents in a column of that name."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    pairs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    size = pairs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = shard_count(docs.sparkSession, size, SHARD_BYTES)
    id_type = pairs.schema["doc_id"].dataType
    named = target.select(F.col(f"`{doc_id}`").cast(id_type).alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    # A target goes to each shard that has a row of its id; ids move, texts do not.
    named = cut_lineage(pairs.where("doc_id IS NOT NULL").select("doc_id", shard_of(shards).alias("shard")).distinct()
                        .join(named, "doc_id", "left_semi"))
    both = sharded(pairs, shards).withColumn("is_target", F.lit(False)).union(named.select(
        "doc_id", F.lit(None).cast("string"), F.lit(0).cast("long"), "shard", F.lit(True)))
    by_shard = both.groupBy("shard")

    def ask_words(key: tuple, table: pa.Table) -> pa.Table:
        shard = Shard(table)
        distinct, _, everywhere, in_target = _counts(shard.tokens, shard.copies, shard.target)
        # Every range gets a row, for every answer has the range's part of the totals.
        return rows_of([(b, key[0].as_py(), _WORDS, data) for b, data in sent(distinct, [everywhere, in_target], 64, shards, empty=True)])

    def ask_pairs(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        shard, found, me = Shard(table), answers_of(answers, _WORDS), key[0].as_py()
        totals = sum(np.frombuffer(data[:56], np.uint64) for _, data in found)
        counts = pack(*_joined(found, 56))
        words = _vocabulary(shard, counts, totals)
        distinct, _, everywhere, in_target = _counts(_pairs(shard, words), shard.copies, shard.target)
        rows = [(shards + me, me, _NOTE, totals.tobytes() + counts)]
        return rows_of(rows + [(b, me, _PAIRS, data) for b, data in sent(distinct, [everywhere, in_target], PAIR_BITS, shards)])

    def finish(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        shard = Shard(table)
        _, note = answers_of(answers, _NOTE)[0]
        words = _vocabulary(shard, note[56:], np.frombuffer(note[:56], np.uint64))
        pair = _pairs(shard, words)
        _, number = np.unique(pair, return_inverse=True)
        everywhere, in_target = (c.astype(float)[number] for c in _joined(answers_of(answers, _PAIRS)))
        n = shard.sizes
        mean = [np.bincount(shard.doc, weights=loss, minlength=n.size) / n for loss in _losses(shard, words, pair, everywhere, in_target)]
        row, copies = chunks_of_copies(shard.times)
        return pa.Table.from_arrays([shard.ids.take(pa.array(row)), *(pa.array(c[row]) for c in (n, *mean, mean[0] - mean[1])), pa.array(copies)],
                                    schema=arrow_schema)

    out = StructType.fromDDL(f"doc_id {id_type.simpleString()}, n_tokens long, target_loss double, background_loss double, difference double, copies long")
    arrow_schema = to_arrow_schema(out)
    words = by_shard.applyInArrow(ask_words, ROWS).groupBy("bucket").applyInArrow(_sums, ROWS)
    asked = by_shard.cogroup(words.groupBy("shard")).applyInArrow(ask_pairs, ROWS)
    answered = asked.groupBy("bucket").applyInArrow(_sums, ROWS)
    return with_copies(by_shard.cogroup(answered.groupBy("shard")).applyInArrow(finish, out))
