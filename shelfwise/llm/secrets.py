"""Secret scan in DataFrame functions: pattern kinds, and runs of high sliding-window entropy.

Java's regular expressions tell what matched, not where. The places come from the texts between the
matches: a match starts after all gaps and matches before it. Places count code points.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.common import fresh_name

ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 12
# Greedy runs: a lower bound in the pattern keeps the same matches as a check of their length.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"

WINDOW = 20
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
# What is known not to be a secret, wherever it stands in a candidate; the rest is judged alone. A word
# is known as a whole piece only, and so are the pieces of a path. No pattern backtracks into a loop.
KNOWN = "|".join((
    "[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    "(?<![A-Za-z0-9])(?i:example|dummy|placeholder|changeme)(?![A-Za-z0-9])",
    "(?<![A-Za-z0-9])(?:[a-z]{3,}+[/_-]){3,}+",
))


@dataclass(frozen=True)
class CharacterClass:
    """Candidates in which every pattern of ``needs`` is found, and the bits a window must reach."""

    kind: str
    needs: tuple[str, ...]
    bits: float


CLASSES = (
    CharacterClass("entropy_hex", ("^[0-9A-Fa-f]+$", "[0-9]", "[A-Fa-f]"), 3.0),
    CharacterClass("entropy_base64", ("[0-9].*[0-9]", "[A-Z]", "[a-z]"), 3.7),
)
# Spans with an equal start come in this order.
KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))
SPANS = "array<struct<start:int,rank:int,end:int>>"
WORDS = "array<struct<start:int,end:int,word:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, zero: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """What the values before each one come to, ``zero`` for the first.

    An array grows by copying, so the values are taken in runs of about the square root of their
    number: first what each run comes to, then the inside of each.
    """

    def grown(start, steps, value):
        return F.aggregate(steps, F.array(start), lambda done, x: F.array_append(
            done, combine(F.element_at(done, -1), value(x))
        ))

    def of(values):
        size = F.size(values)
        run = F.greatest(F.lit(1), F.ceil(F.sqrt(size)).cast("int"))
        return _let(run, lambda run: F.transform(
            F.sequence(F.lit(0), F.greatest(F.lit(0), size - 1), run),
            lambda at: F.slice(values, at + 1, run),
        ))

    def inside(runs):
        starts = grown(zero, runs, lambda r: F.aggregate(r, zero, combine))
        return F.flatten(F.zip_with(runs, starts, lambda r, start: F.when(
            r.isNotNull(), F.slice(grown(start, r, lambda x: x), F.lit(1), F.size(r))
        ).otherwise(F.array().cast("array<int>"))))

    return _let(_let(values, of), inside)


def _pieces(text: Column, pattern: str, group: int = 0) -> Column:
    """The matches of a pattern in order, each with the gap before it; the last gap has none. A
    piece has ``start`` and ``end`` of its gap, the ``match``, and the match's ``value``."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.arrays_zip(
        whole.alias("match"), value.alias("value"), F.split(text, pattern, -1).alias("gap")
    )

    def placed(rows):
        sizes = F.transform(
            rows, lambda r: F.length(r["gap"]) + F.coalesce(F.length(r["match"]), F.lit(0))
        )
        starts = _running(sizes, F.lit(0), lambda x, y: x + y)
        return F.zip_with(rows, starts, lambda r, start: F.struct(
            start.alias("start"), (start + F.length(r["gap"])).alias("end"),
            r["gap"].alias("gap"), r["match"].alias("match"), r["value"].alias("value"),
        ))

    return _let(rows, placed)


def _located(text: Column, pattern: str, rank: int, group: int = 0, least: int = 0) -> Column:
    """Spans of the matches whose ``group`` has ``least`` characters or more."""
    matched = F.filter(_pieces(text, pattern, group), lambda p: F.length(p["value"]) >= least)
    spans = F.transform(matched, lambda p: F.struct(
        p["end"].alias("start"), F.lit(rank).alias("rank"),
        (p["end"] + F.length(p["match"])).alias("end"),
    ))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPANS))


def _candidates(text: Column) -> Column:
    """Start, end and text of the runs that may be secrets, without what is known not to be one."""
    found = F.transform(
        F.filter(_pieces(text, CANDIDATE), lambda p: p["match"].rlike("[0-9]")),
        lambda p: _word(p["end"], p["match"]),
    )

    def unknown(c):
        gaps = F.filter(_pieces(c["word"], KNOWN), lambda p: F.length(p["gap"]) >= WINDOW)
        rest = F.transform(gaps, lambda p: _word(c["start"] + p["start"], p["gap"]))
        return F.when(c["word"].rlike(KNOWN), rest).otherwise(F.array(c))

    words = F.filter(F.flatten(F.transform(found, unknown)), lambda c: c["word"].rlike("[0-9]"))
    return F.when(text.rlike(CANDIDATE), words).otherwise(F.array().cast(WORDS))


def _word(start: Column, text: Column) -> Column:
    return F.struct(start.alias("start"), (start + F.length(text)).alias("end"), text.alias("word"))


def _weight(count: Column) -> Column:
    """c * log2(c), zero for zero."""
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def window_entropy(value: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits, of ``window`` consecutive characters of an ASCII text.

    As the window moves by one, the sum of c * log2(c) over its characters changes by the counts of
    the character that comes and of the one that goes alone; both are counted among the characters
    that stay. A shorter text gives null.
    """

    def moved(letters, state, at):
        comes, leaves = F.get(letters, at - 1), F.get(letters, at - window - 1)
        stay = F.slice(letters, F.greatest(F.lit(1), at - window + 1), F.lit(window - 1))
        stay = F.slice(stay, F.lit(1), F.least(at - 1, F.lit(window - 1)))

        def count(letter):
            return F.size(F.filter(stay, lambda x: x == letter))

        was = F.when(leaves.isNotNull(), count(leaves) + 1)
        change = F.coalesce(_weight(was - 1) - _weight(was), F.lit(0.0))
        before = count(comes)
        total = state["total"] + change + _weight(before + 1) - _weight(before)
        return _let(total, lambda total: F.struct(
            total.alias("total"),
            F.when(at >= window, F.least(state["least"], total)).alias("least"),
        ))

    def lowest(letters):
        begin = F.struct(F.lit(0.0).alias("total"), F.lit(None).cast("double").alias("least"))
        places = F.sequence(F.lit(1), F.size(letters))
        return F.aggregate(places, begin, lambda s, at: moved(letters, s, at))["least"]

    least = _let(F.transform(F.split(value, ""), F.ascii), lowest)
    bits = F.log2(F.lit(float(window))) - least / window
    return F.when(F.length(value) >= window, F.round(bits, 9))


def _entropy_spans(words: Column, base: Column) -> Column:
    """Candidates of high entropy for their class that no base span covers."""
    no_word = F.lit(None).cast("string")
    # Base spans of an equal start come first. The candidates behind a base span's end are not its.
    events = F.concat(
        F.transform(base, lambda b: F.struct(
            b["start"].alias("start"), F.lit(0).alias("asked"), b["end"].alias("end"),
            no_word.alias("word"),
        )),
        F.transform(words, lambda w: F.struct(
            w["start"].alias("start"), F.lit(1).alias("asked"), w["end"].alias("end"),
            w["word"].alias("word"),
        )),
    )

    def uncovered(events):
        ends = F.transform(events, lambda e: F.when(e["asked"] == 0, e["end"]).otherwise(0))
        reach = _running(ends, F.lit(0), lambda x, y: F.greatest(x, y))
        marked = F.zip_with(events, reach, lambda e, r: F.when(
            (e["asked"] == 1) & (r < e["end"]), e
        ))
        return F.filter(marked, lambda e: e.isNotNull())

    def ranked(e):
        rank = F.lit(None).cast("int")
        for c in reversed(CLASSES):
            fits = reduce(Column.__and__, [e["word"].rlike(p) for p in c.needs])
            rank = F.when(fits & (e["bits"] >= c.bits), F.lit(KINDS.index(c.kind))).otherwise(rank)
        return F.struct(e["start"].alias("start"), rank.alias("rank"), e["end"].alias("end"))

    def scored(e):
        return F.struct(
            *[e[c].alias(c) for c in ("start", "end", "word")],
            window_entropy(e["word"]).alias("bits"),
        )

    alone = _let(F.sort_array(events), uncovered)
    found = F.transform(F.transform(alone, scored), ranked)
    spans = F.filter(found, lambda s: s["rank"].isNotNull())
    return F.when(F.size(words) > 0, spans).otherwise(F.array().cast(SPANS))


def with_spans(docs: DataFrame, text: str, base: str, spans: str) -> DataFrame:
    """``docs`` with two array columns of (start, rank, end): the pattern kinds alone, and all.

    Both are sorted by start, then by the kind's place in ``KINDS``. A null text has no spans.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = F.concat(
        _located(body, ASSIGN, 0, 2, ASSIGN_VALUE), _located(body, ACCESS, 1), _located(body, HEX, 2)
    )
    runs = fresh_name(docs, "runs")
    marked = docs.withColumns({base: F.sort_array(found), runs: _candidates(body)})
    extra = _entropy_spans(F.col(runs), F.col(base))
    return marked.withColumn(spans, F.sort_array(F.concat(F.col(base), extra))).drop(runs)


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])
        ),
        ",",
    )


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, ``n_assign``, ``n_access``, ``n_hex``, ``base`` and
    ``spans`` (arrays of start, rank, end, sorted).

    Assignments need a value of 12 characters, access keys 18, hexadecimal runs 16. Further spans
    are runs of 20 or more characters of base64 with a window of high entropy, unless a pattern
    covers them; of a run with something the allow-list knows, the rest is judged. Spans of an equal
    start come in the order of ``KINDS``. Null and empty texts have no spans; repeated rows are
    scanned each; other columns are not read; an empty table gives no rows. Long texts cost time in
    proportion to their length, and to the power 1.5 of the number of their candidates.
    """
    keyed = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    found = with_spans(keyed, "text", "base", "spans")

    def count(rank):
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        F.col("key").alias(key),
        *[count(i).alias(f"n_{KINDS[i]}") for i in range(3)],
        "base",
        "spans",
    )


def redacted(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; all rows and columns stay.

    Overlapping spans are replaced once. A column ``n_chars`` follows the text. A null text stays
    null.
    """
    base, spans = fresh_name(docs, "base_spans"), fresh_name(docs, "all_spans")
    marked = with_spans(docs, text, base, spans)
    body = F.col(f"`{text}`")

    def replaced(spans):
        done = _running(F.transform(spans, lambda s: s["end"]), F.lit(0), lambda x, y: F.greatest(x, y))
        parts = F.zip_with(spans, done, lambda s, at: F.when(
            s["start"] >= at, F.concat(F.substring(body, at + 1, s["start"] - at), F.lit(mark))
        ).otherwise(""))
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(parts, ""), F.substring(body, last + 1, F.length(body)))

    end = _let(F.col(spans), replaced)
    changed = marked.withColumn(text, F.when(F.size(spans) > 0, end).otherwise(body))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        size = F.length(f"`{text}`").cast(kind)
        changed = changed.withColumn(
            "n_chars", F.when(F.size(spans) > 0, size).otherwise(F.col("n_chars"))
        )
    return changed.select(*[f"`{c}`" for c in docs.columns])
