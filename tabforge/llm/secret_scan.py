"""Secret scans in DataFrame functions only: fixed patterns, and a battery of randomness tests.

Next to the patterns, every run of 20 or more key characters is tested. Its
encoding is inferred from its characters. Over the alphabet of that encoding
three tests ask whether it is random: chi-squared for a uniform alphabet, runs
around the middle of the alphabet and lag-one serial correlation. Bonferroni's
correction joins their p-values to one. A run stays a candidate unless that one rejects
randomness under the rule below. The alternative is text, and a secret must also
differ from it: its letters and the changes between upper case, lower case and
digits are compared with what words give, and both combine by Fisher's method.
The encoding says which property of the letters is compared: that all are a to f
in hex, how rare they are in base32 and lower case, else how often they repeat
(the chi-squared statistic again, as index of coincidence). Short runs
carry little evidence, so false discoveries are controlled for both decisions by
Benjamini and Hochberg's rule within each doubling of the length, over the whole
corpus: first for runs called not random, then for the others called secrets.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.columns import unused, without
from tabforge.session import materialize

# The patterns and least lengths of the three base kinds, in their order.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"((?<![0-9a-f])[0-9a-f]{32,}+)"
KEY_RUN = r"((?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+)"
KINDS = ("assign", "access", "hex", "random")

# Sums of the squares and cubes of the letter frequencies of English text.
TEXT_SQUARES, TEXT_CUBES = 0.0655, 0.0054

# Letter frequencies of English text in per mille, a to z, and the share of the letters a to f.
LETTERS = (82, 15, 28, 43, 127, 22, 20, 61, 70, 1.5, 7.7, 40, 24, 67, 75, 19, 0.95, 60, 63, 91, 28, 9.8, 24, 1.5, 20, 0.74)
_LOGS = [math.log(x / sum(LETTERS)) for x in LETTERS]
_LOG_MEAN = sum(x * y for x, y in zip(LETTERS, _LOGS, strict=True)) / sum(LETTERS)
_LOG_SPREAD = math.sqrt(sum(x * (y - _LOG_MEAN) ** 2 for x, y in zip(LETTERS, _LOGS, strict=True)) / sum(LETTERS))
HEX_SHARE = sum(LETTERS[:6]) / sum(LETTERS)

# Alphabets of the encodings, tried in this order.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "mixed": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_=",
}


HEXES = (ALPHABETS["hex"], ALPHABETS["HEX"])
SINGLE = (ALPHABETS["base32"], ALPHABETS["lower"])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, pattern: str, may_match: Column) -> Column:
    """All leftmost matches as structs of start, end (code points, end exclusive) and value (the pattern's group).

    Each step takes what lies before the next match and the match, anchored at
    the end of the one before, so a text is read once; positions are running
    sums of their lengths. Texts that cannot match are not searched.
    """
    steps = F.lit(rf"(?s)\G(.*?)({pattern})")
    parts = F.arrays_zip(*[F.regexp_extract_all(text, steps, F.lit(g)).alias(n) for g, n in ((1, "before"), (2, "whole"), (3, "value"))])

    def placed(found: Column) -> Column:
        sizes = F.transform(found, lambda p: (F.char_length(p["before"]) + F.char_length(p["whole"])).cast("long"))
        ends = F.aggregate(sizes, F.array(F.lit(0).cast("long")), lambda sums, s: F.concat(sums, F.array(F.element_at(sums, -1) + s)))

        def spans(e: Column) -> Column:
            return F.transform(
                found,
                lambda p, i: F.struct(
                    (F.get(e, i) + F.char_length(p["before"])).alias("start"), F.get(e, i + 1).alias("end"), p["value"].alias("value")
                ),
            )

        return _let(ends, spans)

    none = F.array().cast("array<struct<start:long,end:long,value:string>>")
    return F.when(may_match, _let(parts, placed)).otherwise(none)


def base_spans(text: Column) -> Column:
    """Sorted spans of the three fixed kinds."""
    found = (
        (matches(text, ASSIGN, F.rlike(text, F.lit(ASSIGN))), 8),
        (matches(text, ACCESS, F.contains(text, F.lit("AKIA"))), 16),
        (matches(text, HEX, F.rlike(text, F.lit(HEX))), 32),
    )
    kinds = [_of_kind(spans, no, least) for no, (spans, least) in enumerate(found)]
    return F.array_sort(F.concat(*kinds))


def _of_kind(spans: Column, no: int, least: int) -> Column:
    long_enough = F.filter(spans, lambda s: F.char_length(s["value"]) >= least)
    return F.transform(long_enough, lambda s: F.struct(s["start"].alias("start"), F.lit(no).alias("kind_no"), s["end"].alias("end")))


def count_of(spans: str | Column, kind: str) -> Column:
    """Number of spans of one kind."""
    no = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind_no"] == no)).cast("long")


def upper_tail(z: Column) -> Column:
    """P(N(0,1) >= z), to a few hundredths of its value for any z."""
    x = F.greatest(F.abs(z), F.lit(1e-6))
    tail = (1 - F.exp(-1.4 * x)) * F.exp(-x * x / 2) / (1.135 * 2.5066282746310002 * x)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def alphabet(value: Column) -> Column:
    """The alphabet of the inferred encoding."""
    branch = None
    for letters in list(ALPHABETS.values())[:-1]:
        fits = F.char_length(F.translate(value, letters, "")) == 0
        branch = F.when(fits, F.lit(letters)) if branch is None else branch.when(fits, F.lit(letters))
    return branch.otherwise(F.lit(ALPHABETS["mixed"]))


def joint(*ps: Column) -> Column:
    """The smallest of several p-values with Bonferroni's correction, which holds for tests of the same characters."""
    return F.least(len(ps) * F.least(*ps), F.lit(1.0))


def fisher(*ps: Column) -> Column:
    """Fisher's method for two independent p-values."""
    half = -sum((F.log(F.greatest(p, F.lit(1e-150))) for p in ps), F.lit(0.0))
    return F.least((1 + half) * F.exp(-half), F.lit(1.0))


def battery(value: Column, changes: float = 0.25) -> Column:
    """Struct of ``length``, ``uniform``, ``runs`` and ``serial`` (p-values of the three tests), ``random`` (the three
    joined: the chance that a random run looks as ordered as this) and ``text`` (the chance that words look as random).

    ``changes`` is the share of neighbours of different class that text may
    have. Runs under 16 characters prove nothing: all their p-values are 1.
    """
    core = F.rtrim(value, F.lit("="))

    def tested(n: Column, *ps: Column) -> Column:
        names = ("uniform", "runs", "serial", "random", "text")
        return F.struct(n.cast("long").alias("length"), *[p.alias(name) for name, p in zip(names, ps, strict=True)])

    def tests(c: Column) -> Column:
        n = F.char_length(c).cast("double")
        letters = alphabet(c)

        def with_places(a: Column, at: Column) -> Column:
            size = F.char_length(a).cast("double")
            counts = F.transform(F.sequence(F.lit(1), F.char_length(a)), lambda k: F.size(F.filter(at, lambda x: x == k)).cast("double"))
            squares = F.aggregate(counts, F.lit(0.0), lambda s, k: s + k * k)
            chi = squares * size / n - n
            df = size - 1
            chi_z = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))

            high = F.transform(at, lambda x: (x > size / 2).cast("double"))
            ones = F.aggregate(high, F.lit(0.0), lambda s, x: s + x)
            turns = F.aggregate(F.zip_with(F.slice(high, 1, F.size(at) - 1), F.slice(high, 2, F.size(at)), lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x)
            expected = 2 * ones * (n - ones) / n
            spread = F.sqrt(F.greatest(expected * (expected - 1) / (n - 1), F.lit(1e-9)))
            runs_z = F.abs(turns - expected) / spread

            mean = F.aggregate(at, F.lit(0.0), lambda s, x: s + x) / n
            off = F.transform(at, lambda x: x - mean)
            total = F.aggregate(off, F.lit(0.0), lambda s, x: s + x * x)
            lag = F.aggregate(F.zip_with(F.slice(off, 1, F.size(at) - 1), F.slice(off, 2, F.size(at)), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
            serial_z = F.abs(lag) / F.greatest(total, F.lit(1e-9)) * F.sqrt(n)
            p_uniform = upper_tail(chi_z)
            # With all characters in one half of the alphabet there is one run and its chance is that of the split.
            p_runs = F.when((ones > 0) & (ones < n), F.least(2 * upper_tail(runs_z), F.lit(1.0))).otherwise(F.pow(F.lit(2.0), 1 - n))
            p_serial = F.least(2 * upper_tail(serial_z), F.lit(1.0))

            coincidence = (squares - n) / (n * (n - 1))
            variance = 2 / (n * (n - 1)) * (TEXT_SQUARES + 2 * (n - 2) * TEXT_CUBES - (2 * n - 3) * TEXT_SQUARES**2)
            p_repeats = upper_tail((TEXT_SQUARES - coincidence) / F.sqrt(F.greatest(variance, F.lit(1e-9))))
            p_letters = F.when(letters.isin(*HEXES), hex_letters(c)).when(letters.isin(*SINGLE), rare_letters(c)).otherwise(p_repeats)
            p_changes = upper_tail((class_changes(c) - 0.5 - changes * (n - 1)) / F.sqrt(changes * (1 - changes) * (n - 1)))
            # A run of one case without digits cannot change class: its letters are all the evidence.
            p_text = F.when(letters == ALPHABETS["lower"], F.least(p_letters, F.lit(1.0))).otherwise(fisher(p_letters, p_changes))
            return tested(n, p_uniform, p_runs, p_serial, joint(p_uniform, p_runs, p_serial), p_text)

        places = lambda a: F.transform(F.split(c, ""), lambda x: F.call_function("instr", a, x).cast("double"))
        return _let(letters, lambda a: _let(places(a), lambda at: with_places(a, at)))

    short = tested(F.char_length(core), *[F.lit(1.0)] * 5)
    return F.when(F.char_length(core) >= 16, _let(core, tests)).otherwise(short)


def hex_letters(value: Column) -> Column:
    """The chance that all letters of a text are a to f."""
    return F.pow(F.lit(HEX_SHARE), F.char_length(F.translate(value, "0123456789", "")))


def rare_letters(value: Column) -> Column:
    """The chance that letters of a text are as rare as these, by their mean log frequency; 1 without letters."""
    weights = F.array(*[F.lit(x) for x in (0.0, *_LOGS)])
    m = F.char_length(F.translate(value, "0123456789", "")).cast("double")
    places = F.transform(F.split(F.lower(value), ""), lambda x: F.call_function("instr", F.lit(ALPHABETS["lower"]), x))
    logs = F.aggregate(places, F.lit(0.0), lambda s, k: s + F.get(weights, k))
    return F.when(m > 0, upper_tail((m * _LOG_MEAN - logs) / (_LOG_SPREAD * F.sqrt(m)))).otherwise(1.0)


def class_changes(value: Column) -> Column:
    """Neighbours of different class (upper case, lower case, digit, other); a capital before its word is no change."""
    classes = F.split(F.translate(value, _FROM, _TO), "")
    change = lambda x, y: ((x != y) & ~((x == "A") & (y == "a"))).cast("double")
    pairs = F.zip_with(F.slice(classes, 1, F.size(classes) - 1), F.slice(classes, 2, F.size(classes)), change)
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


_FROM = ALPHABETS["mixed"]
_TO = "A" * 26 + "a" * 26 + "0" * 10 + "+" * 5


def p_bin(p: Column) -> Column:
    """The bin of a p-value: -10 log10, rounded down."""
    return F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-300)))).cast("int")


def thresholds(candidates: DataFrame, fdr: float) -> dict[int, int]:
    """Least accepted bin of -10 log10 p for each doubling of the length, by Benjamini and Hochberg's rule on bins.

    A bin counts as its largest p-value. Only counts per doubling and bin are
    shuffled and ordered; the result has one entry per doubling.
    """
    counts = candidates.groupBy("doubling", "bin").agg(F.count(F.lit(1)).alias("c"))
    down = Window.partitionBy("doubling").orderBy(F.col("bin").desc())
    ranked = counts.withColumn("rank", F.sum("c").over(down)).withColumn("m", F.sum("c").over(Window.partitionBy("doubling")))
    passed = ranked.where(F.pow(F.lit(10.0), -F.col("bin") / 10) * F.col("m") <= fdr * F.col("rank"))
    return {r["doubling"]: r["bin"] for r in passed.groupBy("doubling").agg(F.min("bin").alias("bin")).collect()}


def limit_of(found: dict[int, int]) -> Callable[[Column], Column]:
    """The least bin that passes for a doubling, above all bins where none does."""
    limits = F.create_map(*[F.lit(x) for pair in found.items() for x in pair]) if found else F.create_map().cast("map<int,int>")
    return lambda doubling: F.coalesce(F.try_element_at(limits, doubling), F.lit(2**31 - 1))


def scan_secrets(
    docs: DataFrame,
    text_col: str = "text",
    carried: list[str] | None = None,
    fdr: float = 0.01,
    level: float = 0.01,
    changes: float = 0.25,
) -> DataFrame:
    """The ``carried`` columns of ``docs`` (all, unless said otherwise) with ``base`` and ``spans``: sorted structs of start, kind_no and end (code points, end exclusive).

    ``base`` holds the three fixed kinds, ``spans`` also the runs that the
    battery finds and that overlap no base span. ``level`` is the false discovery
    rate of runs called not random, ``fdr`` that of the others called secrets,
    both per doubling of the length. Input columns of these names are replaced. The rows with their candidates are stored once; only counts
    of p-values leave their task. Null and empty texts have no spans; equal
    texts have equal spans; an empty table gives no rows.
    """
    docs = docs.select(*without(docs, ["base", "spans"]))
    kept = docs.columns if carried is None else carried
    (tested,) = unused(docs, "tested_runs")
    text = F.coalesce(F.col(text_col), F.lit(""))
    runs = matches(text, KEY_RUN, F.rlike(text, F.lit(KEY_RUN)))
    free = F.filter(runs, lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    judged = F.transform(
        free,
        lambda r: _let(
            battery(r["value"], changes),
            lambda t: F.struct(
                r["start"].alias("start"),
                r["end"].alias("end"),
                F.floor(F.log2(F.greatest(t["length"], F.lit(1)))).cast("int").alias("doubling"),
                p_bin(t["random"]).alias("ordered"),
                p_bin(t["text"]).alias("bin"),
            ),
        ),
    )
    scanned = docs.withColumn("base", base_spans(text)).withColumn(tested, judged)
    stored = materialize(scanned.select(*[f"`{c}`" for c in kept], "base", tested), "secret-candidates")
    runs = stored.select(F.explode(tested).alias("t")).select("t.*")
    ordered = limit_of(thresholds(runs.select("doubling", F.col("ordered").alias("bin")), level))
    # What is not random counts as a candidate without any evidence.
    bins = F.when(F.col("ordered") < ordered(F.col("doubling")), F.col("bin")).otherwise(0)
    least = limit_of(thresholds(runs.select("doubling", bins.alias("bin")), fdr))
    found = F.filter(tested, lambda t: (t["ordered"] < ordered(t["doubling"])) & (t["bin"] >= least(t["doubling"])))
    random = F.transform(found, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind_no"), t["end"].alias("end")))
    return stored.withColumn("spans", F.array_sort(F.concat("base", random))).drop(tested)


def listed(spans: str | Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind_no"]), s["start"], s["end"])), ",")


def redacted(text: Column, spans: str | Column, mask: str = "[SECRET]") -> Column:
    """The text with each stretch of overlapping spans replaced by ``mask``."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        between = F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        apart = (s["start"] > done["at"]) | (done["at"] == 0)
        out = F.when(apart, F.concat(done["out"], between, F.lit(mask))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    whole = F.aggregate(spans, start, step, lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return F.when(F.size(spans) == 0, text).otherwise(whole)
