"""Secret scan: fixed patterns plus sliding-window entropy, native expressions only.

Entropy part: candidates are maximal runs of token characters. A window of ``WINDOW``
characters slides over a candidate; the entropy follows from the counts of the characters
in the window, updated for the one character that leaves and the one that enters. The
highest window decides, against the threshold of the character class. A candidate is
tested as a whole and in parts (runs without separators, path segments, what allowed parts
leave), so a name in front hides no key. An allow-list pattern suppresses the value it
matches, not the parts beside the match. Everything is per row: no
shuffle, so a hot source or a huge group of copies is spread like the input files are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import once, whole_text

ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# A run of 18 or more is a run of any length that is then tested: the match takes the whole run.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
MIN_VALUE = 12

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
# Characters of the blocks that long candidates are cut into.
BLOCK_CHARS = 256
# Character classes, tested in this order, with the least entropy in bits of a 20-character
# window. Every candidate has one; words of a language and names made of them reach some 3.9
# bits, so what has no digit next to a letter needs more.
CLASSES = [
    ("hex", r"\A[0-9a-fA-F]+\z", 3.0),
    ("alnum", r"\A(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9]+\z", 3.6),
    ("token", r"\A(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_=-]+\z", 3.6),
    ("groups", r"[0-9][A-Za-z]|[A-Za-z][0-9]", 3.6),
    ("letters", r"\A[^0-9]+\z", 4.0),
    ("other", r"", 4.2),  # numbers beside words, such as '12345678/how-do-i'
]
UUID = (
    r"(?<![A-Za-z0-9])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![A-Za-z0-9])"
)
TIME = (
    r"(?<![A-Za-z0-9])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9])"
    r"(?:[T_-](?:[0-9]{2}(?:-?[0-9]{2}){0,2}(?:[_-][0-9]{1,9})?Z?)(?![A-Za-z0-9]))?"
)
ALLOW_LIST = [
    r"(?i)example|sample|placeholder|dummy|changeme|your[_-]",
    UUID,
    r"(?i)/(?:[a-z_-]+/){2}",  # file or url path of words
    TIME,
]
# What is tested of a candidate besides the whole: runs without separators, and what is left
# when allowed parts are cut out, path segments apart and words of a path (or names before '=') left out.
RUN = r"[A-Za-z0-9]{20,}"
WORD = r"(?<![^/=])(?:[A-Za-z]?[a-z_-]*|[A-Z_-]*)[0-9]{0,4}(?![^/=])"
ALLOWED_PARTS = rf"{UUID}|{TIME}"
KINDS = ["assign", "access", "hex", "entropy"]
# c * log2(c) in millionths of a bit: whole numbers, so sums do not depend on their order.
_SCALE = 1_000_000
_PLOGP = [round(c * math.log2(c) * _SCALE) if c else 0 for c in range(WINDOW + 1)]


def spans(text: Column, pattern: str, rank: int, keep=None) -> Column:
    """Array of (start, end, rank, value) in code points, of the leftmost matches.

    Matches and the gaps between them alternate, so running lengths give the places. They
    are summed in blocks of as many pairs as the square root of their number, since an array
    is copied when something is appended to it.
    """
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int,rank:int,value:string>>")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(rank).alias("rank"), pair["hit"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    def placed(pairs: Column) -> Column:
        return once(F.ceil(F.sqrt(F.size(pairs))).cast("int"), lambda n: in_blocks(pairs, n))

    def in_blocks(pairs: Column, n: Column) -> Column:
        zero = F.lit(0)
        block = lambda i: F.slice(pairs, i * n + 1, n)
        numbers = F.sequence(zero, F.ceil(F.size(pairs) / n).cast("int") - 1)
        length = lambda i: F.aggregate(
            block(i), zero, lambda acc, p: acc + F.length(p["gap"]) + F.length(p["hit"])
        )

        def laid(lengths: Column) -> Column:
            before = lambda i: F.aggregate(F.slice(lengths, 1, i), zero, lambda acc, x: acc + x)
            start = lambda i: F.struct(before(i).alias("at"), empty.alias("out"))
            return F.flatten(F.transform(numbers, lambda i: F.aggregate(block(i), start(i), step, lambda s: s["out"])))

        return once(F.transform(numbers, length), laid)

    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda p: p["hit"].isNotNull())
    found = once(pairs, placed)
    if keep is not None:
        found = F.filter(found, lambda s: keep(s["value"]))
    # The first look is cheap and most texts have no match at all.
    return F.when(text.rlike(pattern), found).otherwise(empty)


def max_entropy(value: Column) -> Column:
    """Highest entropy in millionths of a bit of any WINDOW characters of ``value``, which has as many.

    The value is cut into blocks that overlap by a window less one character: every window lies
    in one, and taking a character out of a block costs the same anywhere in the value.
    """

    def highest(blocks: Column) -> Column:
        after = lambda i: F.left(F.coalesce(F.get(blocks, i + 1), F.lit("")), F.lit(WINDOW - 1))
        pieces = F.transform(blocks, lambda block, i: F.concat(block, after(i)))
        return F.array_max(F.transform(F.filter(pieces, lambda p: F.length(p) >= WINDOW), _block_entropy))

    return once(F.regexp_extract_all(value, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0)), highest)


def _block_entropy(value: Column) -> Column:
    table = F.array(*[F.lit(v) for v in _PLOGP])
    log_window = round(math.log2(WINDOW) * _SCALE)

    def count(part: Column, char: Column) -> Column:
        return F.length(part) - F.length(F.replace(part, char, F.lit("")))

    first = F.substring(value, 1, WINDOW)
    start = F.aggregate(
        F.array_distinct(F.split(first, "")),
        F.lit(0),
        lambda acc, ch: acc + F.get(table, count(first, ch)),
    )

    def slide(state: Column, i: Column) -> Column:
        gone, came = F.substr(value, i, F.lit(1)), F.substr(value, i + WINDOW, F.lit(1))
        core = F.substr(value, i + 1, F.lit(WINDOW - 1))
        left, right = count(core, gone), count(core, came)
        change = (
            F.get(table, left) - F.get(table, left + 1) + F.get(table, right + 1) - F.get(table, right)
        )
        total = state["sum"] + change
        return F.struct(total.alias("sum"), F.least(state["best"], total).alias("best"))

    steps = F.when(
        F.length(value) > WINDOW, F.sequence(F.lit(1), F.length(value) - WINDOW)
    ).otherwise(F.array().cast("array<int>"))
    least = F.aggregate(
        steps, F.struct(start.alias("sum"), start.alias("best")), slide, lambda s: s["best"]
    )
    return F.lit(log_window) - F.floor(least / WINDOW)


def passes(value: Column) -> Column:
    """Whether a value of WINDOW characters or more passes the threshold of its class and no allow-list pattern."""
    limit = F.lit(None).cast("long")
    for _, pattern, bits in reversed(CLASSES):
        limit = F.when(value.rlike(pattern), F.lit(round(bits * _SCALE))).otherwise(limit)
    allowed = F.lit(False)
    for pattern in ALLOW_LIST:
        allowed = allowed | value.rlike(pattern)
    return F.when(allowed, F.lit(False)).otherwise(max_entropy(value) >= limit)


def suspicious(value: Column) -> Column:
    """Whether a candidate, or a part of it that stands beside what is allowed, passes."""
    runs = F.regexp_extract_all(value, F.lit(RUN), F.lit(0))
    cut = F.regexp_replace(value, ALLOWED_PARTS, "\x20")
    parts = F.flatten(
        F.array(F.split(cut, r"[\x20/=]+"), F.split(F.regexp_replace(cut, WORD, "\x20"), r"[+/_=-]*\x20[+/_=\x20-]*"))
    )
    long_parts = F.filter(parts, lambda p: F.length(p) >= WINDOW)
    return F.exists(F.array_distinct(F.concat(F.array(value), runs, long_parts)), passes)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, base (array of base spans), added (entropy spans).

    A span is (start, end, rank, value), places in code points, end exclusive, rank the
    position in ``KINDS``. Null and empty texts have no spans; repeated rows repeat their
    result; other columns are not read. Base spans of different kinds may overlap. An
    entropy span never overlaps a base span, which says it already: of such a candidate, what
    the base spans leave is tested.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))

    def long_value(hit: Column) -> Column:
        return F.length(F.regexp_extract(hit, ASSIGN, 2)) >= MIN_VALUE

    base = F.concat(
        spans(F.col("text"), ASSIGN, 0, long_value),
        spans(F.col("text"), ACCESS, 1),
        spans(F.col("text"), HEX, 2),
    )
    found = rows.select("doc_id", base.alias("base"), spans(F.col("text"), CANDIDATE, 3).alias("candidates"))

    def left(c: Column) -> Column:
        over = F.filter("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

        def blank(value: Column, b: Column) -> Column:
            start = F.greatest(b["start"] - c["start"], F.lit(0))
            n = F.least(b["end"], c["end"]) - c["start"] - start
            return F.overlay(value, F.repeat(F.lit(" "), n), start + 1, n)

        return F.struct(c["start"].alias("at"), F.aggregate(over, c["value"], blank).alias("value"))

    def placed(c: Column) -> Column:
        return F.transform(
            spans(c["value"], CANDIDATE, 3, suspicious),
            lambda s: F.struct(
                (c["at"] + s["start"]).alias("start"), (c["at"] + s["end"]).alias("end"), s["rank"], s["value"]
            ),
        )

    added = F.flatten(F.transform(F.transform("candidates", left), placed))
    return found.select("doc_id", "base", added.alias("added"))


def joined(found: Column) -> Column:
    """Spans as kind:start:end, by start, then kind as listed."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"], s["rank"], s["end"])))
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ","
    )


def count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["rank"] == KINDS.index(kind))).cast("bigint")
