"""Secret scans: fixed patterns, and a battery of randomness tests.

The patterns find assigned passwords and tokens, access keys and long
hexadecimal strings. Beside them every run of 16 or more characters that looks
like an encoding (hexadecimal, base 32, base 36, base 64) is tested for being
random. Paths and prefixes stand in one run with a token, so the runs of letters
and digits, those with ``_`` and ``-`` too and those with ``+`` and ``/`` too
are all candidates, each with its own encoding; a random one within another
random one is no span of its own. The tests are
chi-squared uniformity over eight equal parts of its alphabet, the runs test
about the middle of the alphabet, and serial correlation of neighbours. The
three are combined to one p-value. A candidate is left alone if its randomness
is rejected; rejections are made by the Benjamini-Hochberg rule over all
candidates of the corpus in the same length class (powers of two), so the
share of real secrets among what is left alone stays under ``FALSE_RATE``, and
short candidates, for which the tests say little, do not blur long ones.

Everything is DataFrame expressions: one pass counts p-values (a number for
each length class and hundredth of a decimal log), the second scans. Work grows
with the length of a text, whatever the number of its matches: places are
running sums, and overlaps are found in one pass over sorted spans.

Defined results: positions are code points from 0, ends exclusive; a null text
counts as empty and has no spans; equal rows get equal spans; an empty table
gives an empty result. Other columns, whatever their names, play no part in
:func:`scan` and stay in :func:`redact`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from covtab.llm.common import computed, text_or_empty

# The patterns of the base kinds, in their order, and what a
# match must have: 12 characters assigned, 18 of an access key, 16 of hex.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
LEAST_ASSIGNED = 12
LEAST_ACCESS = 18
KINDS = ("assign", "access", "hex", "random")

#: Candidates of the battery, parts before the runs that hold them, and the
#: least length of each encoding.
CANDIDATES = (r"[A-Za-z0-9]{16,}={0,2}", r"[A-Za-z0-9_-]{16,}={0,2}", r"[A-Za-z0-9+/]{16,}={0,2}")
LEAST_HEX, LEAST_BASE32, LEAST_BASE36, LEAST_BASE64 = 16, 16, 20, 20
PARTS = 8
FALSE_RATE = 0.05
#: p-values are counted in steps of a hundredth of their decimal log, down to 1e-20.
STEPS = 100
DEEPEST = 20

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_MARK, _PLAIN = "\x01", "\x02"


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed only once."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, op) -> Column:
    """``op`` of each value and all before it. Blocks of about the root of their
    number are run through one by one and then put after each other, so the
    copies that an array grows by cost no square of its length."""
    nothing = F.expr("cast(array() as array<int>)")

    def run(block: Column) -> Column:
        def step(state: Column, x: Column) -> Column:
            here = F.when(state["last"].isNull(), x).otherwise(op(state["last"], x))
            return _once(here, lambda v: F.struct(v.alias("last"), F.concat(state["all"], F.array(v)).alias("all")))

        return F.aggregate(block, F.struct(F.lit(None).cast("int").alias("last"), nothing.alias("all")), step, lambda s: s["all"])

    def in_blocks(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / width).cast("int") - 1), lambda b: run(F.slice(v, b * width + 1, width)))

        def put(own: Column) -> Column:
            before = run(F.transform(own, lambda block: F.element_at(block, -1)))
            return _once(before, lambda tops: F.flatten(F.transform(own, lambda block, b: F.when(b == 0, block).otherwise(
                F.transform(block, lambda x: op(F.get(tops, b - 1), x))))))

        return _once(blocks, put)

    return _once(values, lambda v: F.when(F.size(v) == 0, nothing).when(F.size(v) <= 64, run(v)).otherwise(in_blocks(v)))


def _largest(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _matches(text: Column, pattern: str) -> Column:
    """(start, end, text) of the leftmost non-overlapping matches: the text is
    cut at marks around them, and the lengths of the parts give the places.
    ``text`` has no mark."""
    parts = F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK)
    nothing = F.expr("cast(array() as array<struct<start:int,end:int,text:string>>)")

    def placed(p: Column) -> Column:
        # Every other part is a match, from the second on.
        ends = _running(F.transform(p, F.length), lambda a, b: a + b)
        return _once(ends, lambda e: F.transform(F.sequence(F.lit(1), F.size(p) - 2, F.lit(2)), lambda i: F.struct(
            F.get(e, i - 1).alias("start"), F.get(e, i).alias("end"), F.get(p, i).alias("text"))))

    return _once(parts, lambda p: F.when(F.size(p) > 1, placed(p)).otherwise(nothing))


def _bare(token: Column) -> Column:
    return F.rtrim(token, F.lit("="))


def _alphabet(token: Column) -> Column:
    """The alphabet of the encoding that a token looks like, or null."""
    n = F.length(token)
    has = lambda chars: token.rlike(f"[{chars}]")
    return (
        F.when((n >= LEAST_HEX) & token.rlike("^([0-9a-f]+|[0-9A-F]+)$") & has("0-9") & has("a-fA-F"),
               F.when(has("a-f"), F.lit(_DIGITS + _LOWER[:6])).otherwise(F.lit(_DIGITS + _UPPER[:6])))
        .when((n >= LEAST_BASE32) & token.rlike("^[A-Z2-7]+$") & has("2-7") & has("A-Z"), F.lit(_UPPER + "234567"))
        .when((n >= LEAST_BASE36) & token.rlike("^([0-9a-z]+|[0-9A-Z]+)$") & has("0-9") & has("a-zA-Z"),
               F.when(has("a-z"), F.lit(_DIGITS + _LOWER)).otherwise(F.lit(_DIGITS + _UPPER)))
        # Digits are not demanded: one in thirty random tokens of 20 characters has none.
        .when((n >= LEAST_BASE64) & has("A-Z") & has("a-z") & token.rlike("^[A-Za-z0-9+/]+$"),
              F.lit(_UPPER + _LOWER + _DIGITS + "+/"))
        .when((n >= LEAST_BASE64) & has("A-Z") & has("a-z") & token.rlike("^[A-Za-z0-9_-]+$"),
              F.lit(_UPPER + _LOWER + _DIGITS + "-_"))
    )


def _total(values: Column, of) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + of(x))


def _chi_squared(u: Column, n: Column) -> Column:
    """Normal score of the uniformity of values in [0, 1) over ``PARTS`` parts (Wilson and Hilferty)."""
    share = n / PARTS
    parts = F.sequence(F.lit(0), F.lit(PARTS - 1))
    chi = _total(parts, lambda part: F.pow(F.size(F.filter(u, lambda x: F.floor(x * PARTS) == part)) - share, F.lit(2.0)) / share)
    df = PARTS - 1
    return (F.cbrt(chi / df) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))


def _runs(u: Column, n: Column) -> Column:
    """Normal score of the number of runs above and below the middle."""
    high = F.size(F.filter(u, lambda x: x >= 0.5)).cast("double")
    low = n - high
    changes = F.size(F.filter(F.zip_with(u, F.slice(u, 2, F.size(u)), lambda a, b: (a >= 0.5) != (b >= 0.5)), lambda x: x))
    mean = 2 * high * low / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    return F.when(spread > 0, (changes + 1 - mean) / F.sqrt(spread)).otherwise(F.lit(10.0))


def _serial(u: Column, n: Column) -> Column:
    """Normal score of the correlation of neighbours."""

    def score(mean: Column) -> Column:
        spread = _total(u, lambda x: (x - mean) * (x - mean))
        pairs = F.zip_with(F.slice(u, 1, F.size(u) - 1), F.slice(u, 2, F.size(u)), lambda a, b: (a - mean) * (b - mean))
        return F.when(spread > 0, (_total(pairs, lambda x: x) / spread + 1 / n) * F.sqrt(n)).otherwise(F.lit(10.0))

    return _once(_total(u, lambda x: x) / n, score)


def _depth(q: Column) -> Column:
    """Step of -log10 of the chance that a chi-squared variable of three
    degrees of freedom exceeds ``q``."""
    x = F.sqrt(q / 2)
    t = 1 / (1 + 0.3275911 * x)
    # The approximation 7.1.26 of erfc by Abramowitz and Stegun.
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    chance = (poly + F.sqrt(2 * q / math.pi)) * F.exp(-q / 2)
    depth = F.least(-F.log10(F.greatest(F.least(chance, F.lit(1.0)), F.lit(10.0 ** -DEEPEST))), F.lit(float(DEEPEST)))
    return F.floor(depth * STEPS).cast("int")


def _battery(token: Column) -> Column:
    """Step of the combined p-value of a token's randomness; null if it looks like no encoding."""

    def of_values(u: Column) -> Column:
        n = F.size(u).cast("double")
        squares = [F.pow(z, F.lit(2.0)) for z in (F.greatest(_chi_squared(u, n), F.lit(0.0)), _runs(u, n), _serial(u, n))]
        return _depth(squares[0] + squares[1] + squares[2])

    def of_alphabet(alphabet: Column) -> Column:
        letters = F.filter(F.split(token, ""), lambda x: x != "")
        u = F.transform(letters, lambda x: (F.instr(alphabet, x) - 0.5) / F.length(alphabet))
        return F.when(alphabet.isNotNull(), _once(u, of_values))

    return _once(_alphabet(token), of_alphabet)


def _length_class(n: Column) -> Column:
    return F.floor(F.log2(n)).cast("int")


def _candidates(text: Column) -> Column:
    """(start, end, length class, p-value step) of the tokens that look like an encoding."""

    def judged(m: Column) -> Column:
        return _once(_bare(m["text"]), lambda token: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), _length_class(F.length(token)).alias("size_class"),
            _battery(token).alias("depth")))

    # Several patterns may find the same run; sorted, equal ones are neighbours, the first pattern's first.
    def numbered(number: int, pattern: str) -> Column:
        return F.transform(_matches(text, pattern), lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), F.lit(number).alias("pattern"), m["text"].alias("text")))

    placed = F.sort_array(F.concat(*[numbered(number, pattern) for number, pattern in enumerate(CANDIDATES)]))
    first = _once(placed, lambda all_: F.filter(all_, lambda m, i: (i == 0) | (F.get(all_, i - 1)["start"] != m["start"])
                                                | (F.get(all_, i - 1)["end"] != m["end"])))
    distinct = F.sort_array(F.transform(first, lambda m: F.struct(
        m["pattern"].alias("pattern"), m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text"))))
    return F.filter(F.transform(distinct, judged), lambda c: c["depth"].isNotNull())


def _unmarked(text: str) -> Column:
    """The text with another control character for the mark; no pattern takes either."""
    return F.translate(text_or_empty(f"`{text}`"), _MARK, _PLAIN)


def rejection_steps(docs: DataFrame, text: str = "text", false_rate: float = FALSE_RATE) -> dict[int, int]:
    """For each length class, the p-value step from which randomness is
    rejected. At most 31 classes, each counted in at most 2,001 steps."""
    bodies = docs.select(_unmarked(text).alias("body"))
    found = computed(bodies, {"_found": _candidates(F.col("body"))}).select(F.explode("_found").alias("c"))
    counts = found.groupBy("c.size_class", "c.depth").agg(F.count("*").alias("n"))
    own = Window.partitionBy("size_class")
    ranked = counts.withColumns({"as_deep": F.sum("n").over(own.orderBy(F.col("depth").desc())), "all": F.sum("n").over(own)})
    rejected = ranked.where(F.pow(F.lit(10.0), -F.col("depth") / STEPS) <= false_rate * F.col("as_deep") / F.col("all"))
    return {row[0]: row[1] for row in rejected.groupBy("size_class").agg(F.min("depth")).collect()}


def _base(kind: int, spans: Column, test=None) -> Column:
    kept = F.filter(spans, test) if test else spans
    return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def _spans(docs: DataFrame, text: str, steps: dict[int, int]) -> DataFrame:
    """``docs`` with ``_base`` and ``_all``: sorted (start, kind, end)."""
    cut = F.create_map(*[F.lit(x) for pair in sorted(steps.items()) for x in pair]) if steps else F.create_map().cast("map<int,int>")
    body = F.col("_body")
    assigned = lambda m: F.length(F.regexp_extract(m["text"], ASSIGN, 1)) >= LEAST_ASSIGNED
    base = F.concat(
        _base(0, _matches(body, ASSIGN), assigned),
        _base(1, _matches(body, ACCESS), lambda m: F.length(m["text"]) >= LEAST_ACCESS),
        _base(2, _matches(body, HEX)))
    random = F.filter(_candidates(body), lambda c: c["depth"] < F.coalesce(F.try_element_at(cut, c["size_class"]), F.lit(10**6)))
    found = computed(docs.withColumn("_body", _unmarked(text)), {"_base": F.sort_array(base), "_random": random}).drop("_body")
    found = computed(found, {"_widest": _widest(_apart(F.col("_base"), F.col("_random")))}).drop("_random")
    return computed(found, {"_all": F.sort_array(F.concat(F.col("_base"), _base(3, F.col("_widest"))))}).drop("_widest")


_NO_SPAN = "cast(array() as array<struct<start:int,end:int>>)"


def _span(start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), end.alias("end"))


def _apart(base: Column, random: Column) -> Column:
    """The random spans that overlap no base span: in one order of all by their
    starts, no base span before ends behind the start of one, and none after
    starts before its end."""
    far = F.lit(2**31 - 1)
    both = F.sort_array(F.concat(
        F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("random"), b["end"].alias("end"))),
        F.transform(random, lambda c: F.struct(c["start"].alias("start"), F.lit(1).alias("random"), c["end"].alias("end")))))

    def kept(all_: Column) -> Column:
        ends = _running(F.transform(all_, lambda m: F.when(m["random"] == 0, m["end"]).otherwise(F.lit(0))), _largest)
        nexts = F.reverse(_running(F.reverse(F.transform(all_, lambda m: F.when(m["random"] == 0, m["start"]).otherwise(far))),
                                   lambda a, b: F.least(a, b)))
        return _once(ends, lambda e: _once(nexts, lambda n: F.transform(
            F.filter(all_, lambda m, i: (m["random"] == 1) & (F.get(e, i) <= m["start"]) & (F.get(n, i) >= m["end"])),
            lambda m: _span(m["start"], m["end"]))))

    return F.when(F.size(random) == 0, F.expr(_NO_SPAN)).when(
        F.size(base) == 0, F.transform(random, lambda c: _span(c["start"], c["end"]))).otherwise(_once(both, kept))


def _widest(spans: Column) -> Column:
    """The spans that lie within no other (different) one: by start, the longest
    first, none before ends as far behind."""
    ordered = F.transform(F.sort_array(F.transform(spans, lambda c: F.struct(c["start"].alias("start"), (-c["end"]).alias("less")))),
                          lambda c: _span(c["start"], -c["less"]))

    def kept(all_: Column) -> Column:
        ends = _running(F.transform(all_, lambda c: c["end"]), _largest)
        return _once(ends, lambda e: F.filter(all_, lambda c, i: (i == 0) | (F.get(e, i - 1) < c["end"])))

    return F.when(F.size(spans) < 2, spans).otherwise(_once(ordered, kept))


def _shown(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", false_rate: float = FALSE_RATE) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, the numbers of base spans
    by kind, ``n_random``, ``base_spans`` and ``spans`` as kind:start:end."""
    pairs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = _spans(pairs, "text", rejection_steps(docs, text, false_rate))
    count = lambda kind: F.size(F.filter("_all", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
                        _shown(F.col("_base")).alias("base_spans"), _shown(F.col("_all")).alias("spans"))


def _covered(text: Column, spans: Column, cover: str) -> Column:
    """``text`` with each span, or run of overlapping spans, replaced. Finding a
    place in a text takes a walk to it, so the text is cut into blocks first,
    and a gap between spans is joined from its blocks."""

    def gaps(ends: Column) -> Column:
        """(from, length) of what stays before each run, and behind the last."""
        runs = F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda i: (i == 0) | (F.get(spans, i)["start"] >= F.get(ends, i - 1)))
        before = F.transform(runs, lambda i: _once(F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - 1)), lambda at: F.struct(
            at.alias("at"), (F.get(spans, i)["start"] - at).alias("size"))))
        last = F.element_at(ends, -1)
        return F.concat(before, F.array(F.struct(last.alias("at"), (F.length(text) - last).alias("size"))))

    def joined(cuts: Column) -> Column:
        wide = F.greatest(F.lit(1024), F.ceil(F.length(text) / F.sqrt(F.size(cuts))).cast("int"))
        return _once(wide, lambda width: _once(blocks_of(width), lambda blocks: F.array_join(
            F.transform(cuts, lambda cut: piece(width, blocks, cut)), cover)))

    def blocks_of(width: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / width).cast("int")), lambda b: F.substring(text, b * width + 1, width))

    def piece(width: Column, blocks: Column, cut: Column) -> Column:
        first = F.floor(cut["at"] / width).cast("int")
        number = F.floor((cut["at"] + cut["size"] - 1) / width).cast("int") - first + 1
        near = F.array_join(F.slice(blocks, first + 1, F.greatest(number, F.lit(0))), "")
        return F.when(cut["size"] > 0, F.substring(near, cut["at"] - first * width + 1, cut["size"])).otherwise(F.lit(""))

    ends = _running(F.transform(spans, lambda s: s["end"]), _largest)
    return _once(_once(ends, gaps), joined)


def redact(docs: DataFrame, text: str = "text", cover: str = "[SECRET]", false_rate: float = FALSE_RATE) -> DataFrame:
    """``docs`` with each found span, or run of overlapping spans, replaced by
    ``cover``; a column ``n_chars`` is set to the new length. A null text stays null."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").cast("string").alias("_text"))
    found = _spans(whole, "_text", rejection_steps(docs, text, false_rate))
    original = F.col("_text")

    clean = F.when(F.size("_all") > 0, _covered(original, F.col("_all"), cover)).otherwise(original)
    found = found.withColumn("_clean", clean)
    new = {text: F.col("_clean"), "n_chars": F.length("_clean")}
    kinds = dict(docs.dtypes)
    return found.select(*[(new[c].cast(kinds[c]) if c in new else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
