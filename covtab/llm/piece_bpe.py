"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut where no vocabulary piece reaches across: before a run of blanks
and around characters that are part of no longer piece. The distinct stretches
of a block of texts are encoded together as one flat array of symbols. In each
round every stretch finds the least rank among its pairs, merges it at its
leftmost places, and the array is compacted; stretches without a pair leave.
The library merges one place at a time. A round merges all places of the pair
up to the first whose result makes a pair of a better or equal rank with its
neighbours, which would come next, so the outcome is the same.
Characters without a piece become their bytes' pieces.

Defined results: a null text counts as empty and has no ids; equal rows get
equal results; an empty table gives an empty result. Other columns, whatever
their names, play no part. Models with another normaliser than the identity,
without byte pieces, or with user-defined or unused pieces are refused.
"""

from __future__ import annotations

import codecs
import gc
import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
#: Characters of text that are encoded together, and stretches in a generation that a task remembers.
BLOCK_CHARS = 1 << 21
REMEMBERED = 300_000

_NONE = np.int32(2**31 - 1)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    """One replacement character for each byte that is no valid text, as the library's decoder has it."""
    return "�", error.start + 1


class Codec:
    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        normal = [i for i in range(size) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i))]
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        probe = " ａ  ﬁ \n"
        if (any(map(sp.is_unused, range(size))) or not all(sp.is_byte(int(i)) for i in self.byte_ids)
                or sp.normalize(probe) != (" " + probe).replace(" ", BLANK)):
            raise ValueError("a BPE model with byte pieces and the identity normaliser is needed")
        self.size = size
        pieces = {sp.id_to_piece(i): i for i in normal}
        scores = {i: sp.get_score(i) for i in normal}
        order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}

        self.symbol_of = np.arange(0x110000, dtype=np.int32) + size  # a character without a piece is a symbol too
        for piece, i in pieces.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        name = lambda s: int(self.symbol_of[ord(s)]) if len(s) == 1 else pieces.get(s)
        made = [(left, right, order[scores[i]], i) for piece, i in pieces.items() for k in range(1, len(piece))
                if (left := name(piece[:k])) is not None and (right := name(piece[k:])) is not None]
        table = np.array(sorted(made), dtype=np.int64).reshape(-1, 4)
        self.pairs = (table[:, 0] << 32) | table[:, 1]
        self.ranks, self.results = table[:, 2].astype(np.int32), table[:, 3].astype(np.int32)
        self._index_pairs()
        # A merge is safe if every pair that its result is part of has a worse rank.
        best = np.full(size + 0x110000, _NONE, dtype=np.int32)
        np.minimum.at(best, table[:, 0], self.ranks)
        np.minimum.at(best, table[:, 1], self.ranks)
        results_of_rank: dict[int, set[int]] = {}
        for rank, i in zip(self.ranks.tolist(), self.results.tolist()):
            results_of_rank.setdefault(rank, set()).add(i)
        self.safe = np.array([len(results_of_rank.get(r, ())) == 1 and int(best[next(iter(results_of_rank[r]))]) > r
                              for r in range(len(order))], dtype=bool)

        longer = [p for p in pieces if len(p) > 1]
        inside = {c for p in longer for c in p}
        if any(BLANK in p.lstrip(BLANK) for p in longer):
            raise ValueError("a piece has a blank after another character")
        self.inert = "\n" if "\n" not in inside else ""
        self.stretch = re.compile(f"{BLANK}*[^{BLANK}{self.inert}]+|{BLANK}+" + "|\n" * bool(self.inert))
        # Blanks merge last and leftmost first, so a run is cut into longest pieces and a rest, if these hold.
        runs = sorted(len(p) for p in longer if not p.strip(BLANK))
        last = {order[scores[pieces[BLANK * n]]] for n in runs}
        self.blanks: list[list[int]] = []  # ids of runs shorter than the longest piece, and that piece
        if (runs and last == {len(order) - 1} and BLANK in pieces
                and not any(p.startswith(BLANK * 2) and p.strip(BLANK) for p in longer)
                and not any(order[scores[i]] == len(order) - 1 for p, i in pieces.items() if len(p) > 1 and p.strip(BLANK))):
            long = runs[-1]
            found = [[]] + self._merge([BLANK * n for n in range(1, 4 * long)])
            if all(found[n] == [pieces[BLANK * long]] * (n // long) + found[n % long] for n in range(1, 4 * long)):
                self.blanks = found[:long + 1]

        self.decimal = list(map(str, range(size)))
        self.shown = [b""] * size
        for i in normal:
            self.shown[i] = sp.id_to_piece(i).replace(BLANK, " ").encode()
        self.blank_first = {i for i in normal if self.shown[i].startswith(b" ")}
        for b, i in enumerate(self.byte_ids.tolist()):
            self.shown[i] = bytes([b])
        self.shown[sp.unk_id()] = " ⁇ ".encode()
        codecs.register_error("each_byte", _each_byte)

    @staticmethod
    def _slot(pair: np.ndarray, bits: int) -> np.ndarray:
        return ((pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).view(np.int64)

    def _index_pairs(self) -> None:
        """Open addressing, a row of places for each further probe."""
        self.bits = max(4, int(self.pairs.size - 1).bit_length() + 3)
        self.probes, left = [], np.arange(self.pairs.size)
        while left.size or not self.probes:
            slots = (self._slot(self.pairs[left], self.bits) + len(self.probes)) % (1 << self.bits)
            row = np.full(1 << self.bits, -1, dtype=np.int32)
            row[slots] = left
            self.probes.append(row)
            left = left[row[slots] != left]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of pairs of symbols."""
        pair = (left.astype(np.int64) << 32) | right
        slots = self._slot(pair, self.bits)
        ranks, results = np.full(pair.size, _NONE, dtype=np.int32), np.zeros(pair.size, dtype=np.int32)
        todo = np.arange(pair.size)
        for probe, row in enumerate(self.probes):
            found = row[(slots[todo] + probe) % (1 << self.bits)]
            used = found >= 0
            todo, found = todo[used], found[used]
            same = self.pairs[found] == pair[todo]
            ranks[todo[same]], results[todo[same]] = self.ranks[found[same]], self.results[found[same]]
            todo = todo[~same]
            if not todo.size:
                break
        return ranks, results

    def _merge(self, stretches: list[str]) -> list[list[int]]:
        """Ids of each stretch (none empty)."""
        sizes = np.array([len(s) for s in stretches], dtype=np.int64)
        flat = np.frombuffer("".join(stretches).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        symbols = self.symbol_of[flat]
        owner = np.repeat(np.arange(sizes.size), sizes)
        out: list[list[int]] = [[]] * sizes.size
        ranks = np.full(symbols.size, _NONE, dtype=np.int32)
        results = np.zeros(symbols.size, dtype=np.int32)
        todo = np.flatnonzero(owner[:-1] == owner[1:])
        while symbols.size:
            ranks[todo], results[todo] = self._rank(symbols[todo], symbols[todo + 1])
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            least = np.minimum.reduceat(ranks, starts)
            counts = np.diff(np.append(starts, symbols.size))
            done = least == _NONE
            if done.any():
                for k, ids in zip(owner[starts[done]].tolist(), self._finished(symbols, starts[done], counts[done])):
                    out[k] = ids
                stay = np.repeat(~done, counts)
                symbols, owner, ranks, results = symbols[stay], owner[stay], ranks[stay], results[stay]
                least, counts = least[~done], counts[~done]
                if not symbols.size:
                    break
                starts = np.cumsum(counts) - counts
            at = np.flatnonzero(ranks == np.repeat(least, counts))
            # Of places that overlap (as in "aaa") every other one, from the left.
            run = np.concatenate(([True], np.diff(at) != 1))
            in_run = np.arange(at.size) - np.flatnonzero(run)[np.cumsum(run) - 1]
            at = at[in_run % 2 == 0]
            if not self.safe[ranks[at]].all():
                at = self._until_better(at, symbols, owner, ranks, results)
            symbols[at] = results[at]
            keep = np.ones(symbols.size, dtype=bool)
            keep[at + 1] = False
            new = np.cumsum(keep)[at] - 1
            symbols, owner, ranks, results = symbols[keep], owner[keep], ranks[keep], results[keep]
            ranks[new] = _NONE
            near = np.zeros(symbols.size + 1, dtype=bool)
            near[new] = near[new - 1] = True  # the last place also stands for the one before the first
            todo = np.flatnonzero(near[:symbols.size - 1] & (owner[:-1] == owner[1:]))
        return out

    def _until_better(self, at: np.ndarray, symbols: np.ndarray, owner: np.ndarray, ranks: np.ndarray,
                      results: np.ndarray) -> np.ndarray:
        """Of each stretch's places in order, those up to the first whose merge
        makes a pair that is not worse."""
        made, rank, end = results[at], ranks[at], symbols.size - 1
        joined = np.concatenate(([False], (np.diff(at) == 2) & (owner[at[1:]] == owner[at[:-1]])))
        left = np.where(joined, np.roll(made, 1), symbols[np.maximum(at - 1, 0)])
        has_left = (at > 0) & (owner[np.maximum(at - 1, 0)] == owner[at])
        after = np.minimum(at + 2, end)
        has_right = (at + 2 <= end) & (owner[after] == owner[at])
        bad = (has_left & (self._rank(left, made)[0] <= rank)) | (has_right & (self._rank(made, symbols[after])[0] <= rank))
        first = np.concatenate(([True], owner[at[1:]] != owner[at[:-1]]))
        before = np.cumsum(bad) - bad  # bad places before each, over all stretches
        return at[before == before[first][np.cumsum(first) - 1]]

    def _finished(self, symbols: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> list[list[int]]:
        """The ids of finished stretches; characters without a piece as bytes."""
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        own = symbols[np.repeat(starts, counts) + within]
        char = own - self.size
        wide = np.where(char < 0, 1, 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000))
        place = np.cumsum(wide) - wide
        ids = np.empty(int(wide.sum()), dtype=np.int32)
        ids[place[char < 0]] = own[char < 0]
        for c in np.unique(char[char >= 0]).tolist():
            at = place[char == c]
            for k, b in enumerate(chr(c).encode("utf-8", "surrogatepass")):
                ids[at + k] = self.byte_ids[b]
        ends = (place + wide)[np.cumsum(counts) - 1].tolist()
        ids = ids.tolist()
        return [ids[i:j] for i, j in zip([0, *ends], ends)]

    def encode_stretches(self, stretches: list[str]) -> list[list[int]]:
        if not self.blanks:
            return self._merge(stretches)
        bare = [s.lstrip(BLANK) for s in stretches]
        ids = self._merge([BLANK + b if s[0] == BLANK else b for s, b in zip(stretches, bare)])
        for k, (s, b) in enumerate(zip(stretches, bare)):
            n = len(s) - len(b)
            if n > 1:
                alone = ids[k][0] == self.blanks[1][0]  # the last blank merged with no letter
                run = n if alone else n - 1
                longest = len(self.blanks) - 1
                ids[k] = self.blanks[longest] * (run // longest) + self.blanks[run % longest] + ids[k][1 if alone else 0:]
        return ids

    def cut(self, text: str | None) -> list[str]:
        return self.stretch.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def encode(self, text: str | None) -> list[int]:
        return [i for ids in self.encode_stretches(self.cut(text)) for i in ids] if text else []

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.shown.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the blank that encoding puts before it; a
        blank that is a byte of its own is not that one."""
        first = next((i for i in ids if self.shown[i]), None)
        return self.as_text(self.decode_bytes(ids), first in self.blank_first)

    @staticmethod
    def as_text(shown: bytes, blank_first: bool = True) -> str:
        """Decoded bytes as text. What :meth:`encode` gives always begins with a piece that has the blank."""
        return (shown[1:] if blank_first else shown).decode("utf-8", "each_byte")


def _encoded(texts: Iterator[str | None], codec: Codec, form: Callable[[list[int]], tuple]) -> Iterator[list[tuple]]:
    """For each text the formed ids of its stretches. Stretches are remembered
    in two generations, so that those in use stay when the older one goes."""
    known: dict[str, tuple] = {}
    older: dict[str, tuple] = {}

    def flush(block: list[list[str]]) -> Iterator[list[tuple]]:
        nonlocal known, older
        if len(known) > REMEMBERED:
            known, older = {}, known
        missing = set().union(*block) - known.keys()
        known |= {s: older[s] for s in missing & older.keys()}
        new = list(missing - older.keys())
        if new:
            known.update(zip(new, map(form, codec.encode_stretches(new))))
        for cut in block:
            yield list(map(known.__getitem__, cut))

    block, chars = [], 0
    for text in texts:
        block.append(codec.cut(text))
        chars += len(text or "")
        if chars >= BLOCK_CHARS:
            yield from flush(block)
            block, chars = [], 0
    yield from flush(block)


def _mapped(docs: DataFrame, doc_id: str, text: str, model: str | None, schema: str, form, finish) -> DataFrame:
    pairs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, sizes, kept = Codec(model), deque(), deque()

        def texts() -> Iterator[str | None]:
            for batch in batches:
                sizes.append(batch.num_rows)
                kept.append(batch.column(0))
                for text in batch.column(1):
                    yield text.as_py()

        # Texts are encoded in blocks of their own, whatever the batches; rows come back in batches.
        rows = map(finish, _encoded(texts(), codec, lambda ids: form(codec, ids)))
        # What is remembered is many tuples and no cycles; looking for cycles costs half of the time.
        gc.disable()
        try:
            for first in rows:
                while not sizes[0]:
                    sizes.popleft(), kept.popleft()
                found = [first, *islice(rows, sizes.popleft() - 1)]
                yield pa.RecordBatch.from_arrays([kept.popleft(), *map(pa.array, zip(*found))], names)
        finally:
            gc.enable()

    names = ["doc_id", *(c.split()[0] for c in schema.split(", "))]
    return pairs.mapInArrow(run, f"doc_id {pairs.schema['doc_id'].dataType.simpleString()}, {schema}")


def encoded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """``doc_id``, ``ids`` and the ``decoded`` text of each row of ``docs``."""

    def form(codec: Codec, ids: list[int]) -> tuple:
        return ids, codec.decode_bytes(ids)

    def finish(found: list[tuple]) -> tuple:
        ids, shown = zip(*found) if found else ((), ())
        return pa.scalar([*chain(*ids)], pa.list_(pa.int32())), Codec.as_text(b"".join(shown))

    return _mapped(docs, doc_id, text, model, "ids array<int>, decoded string", form, finish)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas)
    and ``decoded_sha256`` of each row of ``docs``."""

    def form(codec: Codec, ids: list[int]) -> tuple:
        return len(ids), ",".join(map(codec.decimal.__getitem__, ids)), codec.decode_bytes(ids)

    def finish(found: list[tuple]) -> tuple:
        counts, decimal, shown = zip(*found) if found else ((), (), ())
        return (sum(counts), hashlib.sha256(",".join(decimal).encode()).hexdigest(),
                hashlib.sha256(Codec.as_text(b"".join(shown)).encode()).hexdigest())

    return _mapped(docs, doc_id, text, model, "n_tokens long, ids_sha256 string, decoded_sha256 string", form, finish)
