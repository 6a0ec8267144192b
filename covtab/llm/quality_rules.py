"""Quality rules: a threshold table compiled into one Spark projection.

Each rule bounds a ratio ``numerator / denominator`` of the counts that
:func:`text_counts` derives from a text. Bounds are in thousandths and the
comparison is on whole numbers, so it is exact. No user function runs.

Defined results: a null text counts as empty (no words); an empty text has
all counts zero and fails the base rule (fewer than 10 words); a rule whose
denominator is under ``least`` passes, and so does a stop-word rule where the
text's language has no list; a text may have any length; rows are judged one by one, so repeated rows get
the same verdict and an empty table gives an empty result. Extra columns are
ignored by :func:`judge` and kept by :func:`keep_good`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covtab.llm.common import computed, text_or_empty, without_spaces, words_of

# The symbols that are counted, and common function words of four
# languages, with their codes.
LISTED = ("en", "fr", "de", "es")
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "a an and are as at be been but by for from had has have he her his if in is it its not of on or "
    "she that the their there they this to was were which will with you "
    "au aux avec ce ces dans de des du elle en est et il la le les leur mais ne nous ou par pas plus "
    "pour que qui sa se ses son sur un une vous "
    "als am auch auf aus bei das dass dem den der des die ein eine einen einer er es hat im in ist "
    "mit nach nicht sich sie sind so um und von war wie wird zu zum zur "
    "al como con del el ella en entre era es esta este fue ha la las lo los mas más no o para pero "
    "por que se si sin son su sus un una y"
).split()

#: Base rule: fewer words than this, or more repeated words than this share.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``low <= 1000 * numerator / denominator <= high``; a bound may be absent.
    The rule applies from ``least`` of the denominator on, and if ``languages``
    are given, to texts in these alone."""

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None
    least: int = 1
    languages: tuple[str, ...] = ()


#: The threshold table. Names in it are columns of :func:`text_counts`.
RULES = (
    Rule("length", "n_words", "one", low=MIN_WORDS * 1000),
    Rule("word_length", "word_chars", "n_words", low=2_000, high=20_000),
    Rule("symbols", "n_symbols", "n_words", high=300),
    Rule("upper_words", "n_upper_words", "n_words", high=600),
    Rule("stop_words", "n_stop_words", "n_words", low=20, least=30, languages=LISTED),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=400),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=300),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=900),
)


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five words that occur twice or more in the text.

    Windows are compared by the 64-bit hash of their words within one text:
    hashes are sorted with their positions, equal neighbours are repeats, and
    the union of the windows is measured from the gaps between their starts.
    """

    def covered(starts: Column) -> Column:
        step = F.transform(
            starts, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - at, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda total, x: total + x)

    def starts_of_repeats(ranked: Column) -> Column:
        same = F.filter(
            ranked,
            lambda x, i: F.coalesce(F.get(ranked, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(ranked, i + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(same, lambda x: x["at"]))

    def once(value: Column, use) -> Column:
        """``use`` of a value that is computed only once per row."""
        return F.transform(F.array(value), use)[0]

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]).alias("h"), i.alias("at")))
    found = once(F.sort_array(windows), lambda ranked: once(starts_of_repeats(ranked), covered))
    return F.when(F.size(words) > WINDOW, found).otherwise(F.lit(0).cast("long"))


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules use, under the names they use.

    A column of ``docs`` with one of those names is replaced.
    """
    has_word = lambda line: F.length(without_spaces(line)) > 0
    parts = docs.withColumns({"_text": text_or_empty(text)}).withColumns({
        "_words": words_of(F.col("_text")),
        "_lines": F.filter(F.split(F.col("_text"), "\n"), has_word),
        "_bare": without_spaces(F.col("_text")),
    })
    w, lines, bare = F.col("_words"), F.col("_lines"), F.col("_bare")
    count = lambda array, test: F.size(F.filter(array, test)).cast("long")
    return computed(parts, {
        "one": F.lit(1).cast("long"),
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(bare).cast("long"),
        "n_symbols": (F.length(bare) - F.length(F.translate(bare, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": _repeat_words(w),
        "n_stop_words": count(w, lambda x: F.lower(x).isin(*STOP_WORDS)),
        "n_upper_words": count(w, lambda x: (F.upper(x) == x) & (F.lower(x) != x)),
        "n_ellipsis_lines": count(lines, lambda x: x.endswith("...") | x.endswith("…")),
        "n_bullet_lines": count(lines, lambda x: F.ltrim(x).startswith("- ") | F.ltrim(x).startswith("* ")
                                | F.ltrim(x).startswith("• ")),
    }).drop("_text", "_words", "_lines", "_bare")


def rule_failed(rule: Rule, lang: Column | None = None) -> Column:
    scaled, den = F.col(rule.numerator) * 1000, F.col(rule.denominator)
    low = scaled < rule.low * den if rule.low is not None else F.lit(False)
    high = scaled > rule.high * den if rule.high is not None else F.lit(False)
    failed = (den >= rule.least) & (low | high)
    if rule.languages:
        # 'en', 'EN' and 'en-GB' are one language; an unknown one is none of them.
        code = F.lit(None) if lang is None else F.lower(F.substring_index(lang.cast("string"), "-", 1))
        failed = failed & F.coalesce(code.isin(*rule.languages), F.lit(False))
    return failed


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (F.col("n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT)


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, lang: str = "lang") -> DataFrame:
    """``docs`` with its counts, ``failed_rules`` (names, in table order),
    ``base_failed`` and ``kept``; one row out for each row in. Columns of these
    names, and ``_text``, ``_words``, ``_lines`` and ``_bare``, are replaced or
    lost; :func:`keep_good` keeps all. Without a column ``lang`` no language is
    known."""
    language = F.col(f"`{lang}`") if lang in docs.columns else None
    names = F.filter(F.array(*[F.when(rule_failed(r, language), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return (text_counts(docs, text)
            .withColumns({"failed_rules": names, "base_failed": base_failed()})
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    language = F.col(f"`{lang}`") if lang in docs.columns else F.lit(None)
    judged = judge(docs.select(whole.alias("_row"), F.col(f"`{text}`").alias("_judged"), language.cast("string").alias("_lang")),
                   "_judged", rules, "_lang")
    return judged.where("kept").select("_row.*")
