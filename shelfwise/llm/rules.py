"""Quality rules, line first: lines are judged and taken out, then the document is.

A document fails at once for too few words or too much repetition. Of the others, lines that read
like menus, noise, shouting, lists without a sentence, repetition or boilerplate are removed; a
document that loses too much of its text that way is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from shelfwise.llm.common import fresh_name, map_text, strings

LEAST_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
# A document is rejected when it loses more than this share of its word characters.
LOST_PERCENT = 30

WORD = regex.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·"
BOILERPLATE = (
    r"(?i)all rights reserved|privacy policy|terms of (use|service)|cookie|javascript|subscribe"
    r"|newsletter|sign (in|up)|log ?in|click here|read more|share (this|on)|lorem ipsum|powered by"
    r"|skip to (main )?content|back to top"
)
# The stops of all scripts, as characters of a class.
STOPS = "".join(
    regex.findall(r"\p{Sentence_Terminal}", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])))
)
_SENTENCE_END = regex.compile(rf"""[{regex.escape(STOPS)}…:;]["'”’)»\]]*(?:[\x20\x09-\x0D]|$)""")
# A line that goes on with the sentence of the line before it.
GOES_ON = r"""^[\x20\x09-\x0D]*["'“‘(«\[]*\p{Ll}"""
_GOES_ON = regex.compile(GOES_ON)
_LOWER, _UPPER = regex.compile(r"\p{Ll}"), regex.compile(r"\p{Lu}")
_BOILERPLATE = regex.compile(BOILERPLATE)


@dataclass
class Judged:
    """What the rules found in one text."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    lost_chars: int
    base_failed: bool
    kept: bool
    text: str


def repeat_words(words: list[str]) -> int:
    """Words inside windows of five words that are found twice or more."""
    if len(words) <= WINDOW:
        return 0
    index: dict[str, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    ranks, size = ids, len(words)
    for step in range(1, WINDOW):
        # Windows of one more word get numbers of their own, equal ones the same.
        pairs = ranks[:size - step] * size + ids[step:]
        _, ranks, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if counts.max() == 1:
            return 0
    starts = np.flatnonzero(counts[ranks] > 1)
    covered = np.zeros(size + 1, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + WINDOW, -1)
    return int((np.cumsum(covered) > 0).sum())


def sentence_ends(lines: list[str]) -> list[bool]:
    """For each line whether a sentence ends in it, or in a line that it is wrapped into: lines go
    on with the one before as long as they begin in lower case."""
    found = [False] * len(lines)
    for i in reversed(range(len(lines))):
        found[i] = _SENTENCE_END.search(lines[i]) is not None or (
            i + 1 < len(lines) and found[i + 1] and _GOES_ON.search(lines[i + 1]) is not None
        )
    return found


def line_fails(line: str, words: list[str], chars: int, ends: bool) -> bool:
    """Whether a line that has words is to be removed, whatever stands before it. ``ends`` tells
    whether a sentence ends in it or in what it is wrapped into."""
    count = len(words)
    separators = sum(line.count(c) for c in SEPARATORS)
    if separators >= 3 and count <= 6 * separators:
        return True
    if 10 * sum(line.count(c) for c in SYMBOLS) > chars:
        return True
    if count >= 3 and not _LOWER.search(line) and _UPPER.search(line):
        return True
    if count >= 4 and not ends:
        return True
    if count >= 8 and 3 * len(set(words)) < count:
        return True
    return count <= 20 and _BOILERPLATE.search(line) is not None


def judge(text: str) -> Judged:
    seen: set[str] = set()
    kept_lines, words = [], []
    chars = lost = repeated = 0
    lines = text.split("\n")
    for line, ends in zip(lines, sentence_ends(lines)):
        own = WORD.findall(line)
        if not own:
            kept_lines.append(line)
            continue
        size = sum(map(len, own))
        words += own
        chars += size
        if again := line in seen:
            repeated += 1
        seen.add(line)
        if again or line_fails(line, own, size, ends):
            lost += size
        else:
            kept_lines.append(line)
    repeats = repeat_words(words)
    failed = len(words) < LEAST_WORDS or 100 * repeats > REPEAT_PERCENT * len(words)
    kept = not failed and 100 * lost <= LOST_PERCENT * chars
    return Judged(
        len(words), chars, sum(text.count(c) for c in SYMBOLS), repeated, repeats, lost, failed, kept,
        "\n".join(kept_lines),
    )


def judged(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, the measures, ``lost_chars``, ``base_failed``, ``kept`` and
    ``cleaned``, the text without the removed lines.

    A null text is empty, has no words and fails. Repeated rows are judged each; other columns are
    not read; an empty table gives no rows. Lines end at line feeds only; a line without words is
    never removed. The sentence rule knows the stops of all scripts, and prose that is wrapped at
    some width; the words of boilerplate are English, so that of other languages is only found by
    the other rules.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars"]

    def run(batch):
        found = [judge(t) for t in strings(batch, "text")]
        counts = [pa.array([getattr(f, n) for f in found], pa.int64()) for n in names]
        flags = [pa.array([f.base_failed for f in found]), pa.array([f.kept for f in found])]
        return pa.RecordBatch.from_arrays(
            [batch.column("key"), *counts, *flags, pa.array([f.text for f in found], pa.string())],
            ["key", *names, "base_failed", "kept", "cleaned"],
        )

    schema = (
        f"key {rows.schema['key'].dataType.simpleString()}, "
        + ", ".join(f"{n} long" for n in names)
        + ", base_failed boolean, kept boolean, cleaned string"
    )
    return map_text(rows, "text", schema, lambda: run).withColumnRenamed("key", key)


def cleaned(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with the removed lines taken out of the text.

    All columns stay, whatever their names; a column ``n_chars`` follows the text. Null and empty
    texts have no words and go; repeated rows are judged alike; an empty table gives no rows.
    """
    name = fresh_name(docs, "kept")
    schema = StructType([*docs.schema.fields, StructField(name, BooleanType())])

    def run(batch):
        found = [judge(t) for t in strings(batch, text)]
        at = batch.schema.get_field_index(text)
        out = batch.set_column(
            at, batch.schema.field(at), pa.array([f.text for f in found], batch.schema.field(at).type)
        )
        return out.append_column(name, pa.array([f.kept for f in found]))

    kept = map_text(docs, text, schema, lambda: run).where(F.col(name)).drop(name)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length(f"`{text}`").cast(docs.schema["n_chars"].dataType))
