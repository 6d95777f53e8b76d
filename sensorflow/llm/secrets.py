"""Secret scan: key patterns, and sliding-window entropy over candidate strings.

DataFrame operations only.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound

#: Kind, pattern, the group whose length counts, its least length.
BASE_KINDS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    # a run that is long enough is the same as any run kept only if long enough
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
ENTROPY_KIND = "entropy"
#: Candidate strings: runs of the characters that keys are written in.
LEAST = 16
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
#: Maximal runs inside candidates that are judged by their own bits.  Runs of lower-case
#: hexadecimal digits need none here: from 16 on each is a base span.
UPPER_HEX = r"[0-9A-F]{16,}"
LETTERS = r"[A-Za-z]{16,}"
#: Elements that running sums and maxima take at a time.
BLOCK = 32
CASE_CHANGE = r"(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Parts that look random and are not: UUIDs, dates with times, dashes and underscores as rules.
#: They and the base spans are cut out of the candidates; what is left of these is judged.
ALLOWED = [
    r"(?<![0-9A-Za-z])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Za-z])",
    r"(?<![0-9A-Za-z])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-SU-Za-z])"
    r"(?:[T_-][0-9]{2}(?:-?[0-9]{2}){0,2}(?:Z|[+-][0-9]{2}-?[0-9]{2})?(?![0-9A-Za-z]))?",
    r"[-_=+/]{16,}",
]


@dataclass(frozen=True)
class EntropyParams:
    """Window length, and bits per character from which a window of a class counts as random:
    upper-case hexadecimal runs (16 symbols), and other candidates and runs of letters (random
    text of 24 characters has about 3.4 and 4.3 bits, words about 3.4).  A shorter run is one
    window, whose bits are scaled by the logarithm of its length."""

    window: int = 24
    hex_bits: float = 3.1
    mixed_bits: float = 4.0


def running(values: Column, combine: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """The running results of ``combine`` (sum, greatest) over an array of whole numbers.

    An aggregate that appends copies its array for each element, so it takes BLOCK elements at a
    time; the blocks' last values run in the same way, and each block continues from the one before.
    """
    def appended(block: Column) -> Column:
        return F.aggregate(block, F.array().cast("array<int>"), lambda out, x: F.concat(out, F.array(
            F.coalesce(combine(F.get(out, F.size(out) - 1), x), x))))

    if not levels:
        return appended(values)

    def continued(blocks: Column) -> Column:
        ends = running(F.transform(blocks, lambda b: F.element_at(b, -1)), combine, levels - 1)
        return bound(ends, lambda e: F.flatten(F.transform(blocks, lambda b, i: F.when(i == 0, b).otherwise(
            F.transform(b, lambda x: combine(F.get(e, i - 1), x))))))

    def blocks(v: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), F.lit(BLOCK))
        return bound(F.transform(starts, lambda at: appended(F.slice(v, at, BLOCK))), continued)

    return bound(values, lambda v: F.when(F.size(v) > 0, blocks(v)).otherwise(F.array().cast("array<int>")))


def matches(text: Column, pattern: str, group: int, least: int) -> Column:
    """Spans (start, end, string) in code points of the leftmost non-overlapping matches whose
    group has at least ``least`` characters.  The text between matches gives their places."""
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"),
                     F.split(text, pattern, -1).alias("between"))
    none = F.array().cast("array<struct<start:int,end:int,string:string>>")

    def places(m: Column) -> Column:
        steps = F.transform(m["whole"], lambda w, i: F.length(F.get(m["between"], i)) + F.length(w))
        spans = bound(running(steps, lambda a, x: a + x), lambda ends: F.transform(m["whole"], lambda w, i: F.struct(
            (F.get(ends, i) - F.length(w)).alias("start"), F.get(ends, i).alias("end"), w.alias("string"),
            (F.length(F.get(m["part"], i)) >= least).alias("long"))))
        return F.transform(F.filter(spans, lambda x: x["long"]), lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["string"].alias("string")))

    return F.when(text.rlike(pattern), bound(found, places)).otherwise(none)


def random_part(string: Column, bits: float, longest: int) -> Column:
    """(start, end) from the first to the last window of at least ``bits`` per character, NULL
    if there is none.  Counts and the sum of c log c change with the character that enters the
    window and the one that leaves it.  A string shorter than ``longest`` is one window, and its
    bits are scaled by the logarithm of its length."""
    return bound(F.least(F.length(string), F.lit(longest)), lambda window: _random_part(
        string, F.lit(bits / math.log2(longest)) * F.log2(window.cast("double")), window, longest))


def _random_part(string: Column, bits: Column, window: Column, longest: int) -> Column:
    all_codes = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    c_log_c = F.array(*[F.lit(0.0)], *[F.lit(c).cast("double") * F.log2(F.lit(c).cast("double"))
                                       for c in range(1, longest + 2)])

    def f(count: Column) -> Column:
        return F.element_at(c_log_c, count + 1)

    def step(codes: Column, s: Column, i: Column) -> Column:
        enters = F.element_at(codes, i)
        leaves = F.when(i > window, F.element_at(codes, i - window)).otherwise(0)
        plus = F.element_at(s["counts"], enters)
        minus = F.when(leaves > 0, F.element_at(s["counts"], F.greatest(leaves, F.lit(1)))).otherwise(0)
        total = F.when(enters == leaves, s["total"]).otherwise(
            s["total"] + f(plus + 1) - f(plus) + F.when(leaves > 0, f(F.greatest(minus - 1, F.lit(0))) - f(minus)).otherwise(0.0))
        counts = F.transform(s["counts"], lambda c, k: c + (k + 1 == enters).cast("int") - (k + 1 == leaves).cast("int"))
        random = (i >= window) & (window.cast("double") * (F.log2(window.cast("double")) - bits) >= total - 1e-9)
        return F.struct(counts.alias("counts"), total.alias("total"),
                        F.when(random & (s["lo"] < 0), i - window).otherwise(s["lo"]).alias("lo"),
                        F.when(random, i).otherwise(s["hi"]).alias("hi"))

    begin = F.struct(F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("total"),
                     F.lit(-1).alias("lo"), F.lit(-1).alias("hi"))
    return bound(all_codes, lambda codes: F.aggregate(
        F.sequence(F.lit(1), F.size(codes)), begin, lambda s, i: step(codes, s, i),
        lambda s: F.when(s["lo"] >= 0, F.struct(s["lo"].alias("lo"), s["hi"].alias("hi")))))


def merged(spans: Column) -> Column:
    """Overlapping spans as one, in order.

    A span that starts where all earlier ones have ended begins a new one, which ends where the
    last span before the next beginning has all ended.
    """
    def joined(x: Column) -> Column:
        heads = F.filter(F.sequence(F.lit(0), F.size(x["spans"]) - 1), lambda i: F.coalesce(
            F.get(x["spans"], i)["start"] >= F.get(x["ends"], i - 1), F.lit(True)))
        return bound(heads, lambda h: F.transform(h, lambda at, i: F.struct(
            F.get(x["spans"], at)["start"].alias("start"),
            F.get(x["ends"], F.coalesce(F.get(h, i + 1), F.size(x["spans"])) - 1).alias("end"))))

    def ordered(s: Column) -> Column:
        ends = running(F.transform(s, lambda x: x["end"]), F.greatest)
        return F.when(F.size(s) > 0, bound(F.struct(s.alias("spans"), ends.alias("ends")), joined)).otherwise(
            F.array().cast("array<struct<start:int,end:int>>"))

    return bound(F.array_sort(spans), ordered)


def without(text: Column, spans: Column) -> Column:
    """The text with blanks in place of the spans (in order, apart from each other).

    A place in a text is found by reading it from its start, so the text is cut at every n-th span
    first, n being the root of their number, and these pieces at the spans in them.
    """
    def kept(x: Column) -> Column:
        def part(s: Column, i: Column) -> Column:
            at = F.coalesce(F.get(x["own"], i - 1)["end"], x["before"])
            return F.concat(F.substr(x["piece"], at - x["before"] + 1, s["start"] - at),
                            F.repeat(F.lit(" "), s["end"] - s["start"]))

        return F.array_join(F.transform(x["own"], part), "")

    def pieces(n: Column) -> Column:
        def piece(first: Column) -> Column:
            before = F.coalesce(F.get(spans, first - 2)["end"], F.lit(0))
            last = F.get(spans, F.least(first + n - 1, F.size(spans)) - 1)["end"]
            return bound(F.struct(F.slice(spans, first, n).alias("own"), before.alias("before"),
                                  F.substr(text, before + 1, last - before).alias("piece")), kept)

        return F.array_join(F.transform(F.sequence(F.lit(1), F.size(spans), n), piece), "")

    tail = F.substr(text, F.element_at(spans, -1)["end"] + 1)
    root = F.ceil(F.sqrt(F.size(spans).cast("double"))).cast("int")
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(bound(root, pieces), tail))


def places(found: Column) -> Column:
    return F.transform(found, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end")))


def with_entropy_spans(rows: DataFrame, text: str, base: str, p: EntropyParams) -> DataFrame:
    """Rows with the random parts of their candidates, from which base spans and allowed patterns
    are cut out.  Each step is a column, as one expression of all nests too deep for the analyser.

    A candidate with a digit and a letter is judged as a whole, and each maximal run of one class
    in it by that class's bits.  Runs of letters are told from words by their case: all of one
    case and at least a window long, or changing it more often than every fourth character.
    """
    allowed = [places(matches(F.col(text), pattern, 0, 1)) for pattern in ALLOWED]
    rows = rows.withColumn("_spans", F.concat(places(F.col(base)), *allowed))
    rows = rows.withColumn("_cut", merged(F.col("_spans")))
    rows = rows.withColumn("_rest", without(F.col(text), F.col("_cut")))
    classes = [(CANDIDATE, p.mixed_bits, is_mixed), (UPPER_HEX, p.hex_bits, is_upper_hex),
               (LETTERS, p.mixed_bits, lambda string: is_letters(string, p.window))]
    for i, (pattern, bits, wanted) in enumerate(classes):
        rows = rows.withColumn(f"_found{i}", matches(F.col("_rest"), pattern, 0, LEAST))
        rows = rows.withColumn(f"_random{i}", judged(F.col(f"_found{i}"), bits, wanted, p))
    rows = rows.withColumn("_random", F.concat(*[f"_random{i}" for i in range(len(classes))]))
    return rows.withColumn(ENTROPY_KIND, merged(F.col("_random")))


def is_mixed(string: Column) -> Column:
    return string.rlike("[0-9]") & string.rlike("[A-Za-z]")


def is_upper_hex(string: Column) -> Column:
    return string.rlike("[0-9]") & string.rlike("[A-F]")


def is_letters(string: Column, window: int) -> Column:
    one_case = string.rlike("^([a-z]+|[A-Z]+)$") & (F.length(string) >= window)
    return one_case | (F.regexp_count(string, F.lit(CASE_CHANGE)) * 4 > F.length(string))


def judged(found: Column, bits: float, wanted: Callable[[Column], Column], p: EntropyParams) -> Column:
    """The random parts of the found strings of one class."""
    def judge(span: Column) -> Column:
        part = F.when(wanted(span["string"]), random_part(span["string"], bits, p.window))
        return bound(part, lambda x: F.struct((span["start"] + x["lo"]).cast("int").alias("start"),
                                              (span["start"] + x["hi"]).cast("int").alias("end")))

    return F.filter(F.transform(found, judge), lambda s: s["start"].isNotNull())


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 params: EntropyParams = EntropyParams()) -> DataFrame:
    """One row per input row: id, base (array of start, kind number, end, kind), added (the same
    for entropy spans), in the order of start and kind; places in code points, end exclusive.

    NULL counts as empty; a text without findings has empty arrays.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    for kind, pattern, group, least in BASE_KINDS:
        rows = rows.withColumn(kind, matches(F.col("_t"), pattern, group, least))

    def tagged(spans: str, rank: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"),
                                                     s["end"].alias("end"), F.lit(spans).alias("kind")))

    kinds = [k[0] for k in BASE_KINDS]
    rows = rows.withColumn("base", F.array_sort(F.concat(*[tagged(k, i) for i, k in enumerate(kinds)])))
    rows = with_entropy_spans(rows, "_t", "base", params)
    return rows.select(F.col("_id").alias(id_col), "base", tagged(ENTROPY_KIND, len(kinds)).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
