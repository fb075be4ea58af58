"""Benchmark decontamination by pigeonhole edit matching.

An item with at most k edits, cut into k + 1 pieces, keeps one piece unchanged. All pieces of all
items are found in one pass over a text with an Aho-Corasick automaton. Where a piece is found, the
stretch of text that the whole item could cover is searched with Myers' bit-parallel algorithm.

Most hits come by chance, so a hit is first verified with its neighbours: pieces are halved into a
tree, and if n pieces together have fewer than n edits, so has one of their halves. Some piece
therefore has this property with all groups above it, and its hit passes the checks of the two
smallest of them.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import kept, map_text, slices, strings, unlike
from shelfwise.session import staged

# One edit is allowed for this many characters of an item.
CHARS_PER_EDIT = 10
# Items are matched in blocks of at most about this many characters, one block after the other. A
# worker holds one block's automaton, about 120 MB at this size.
BLOCK_CHARS = 1 << 20
# Groups of pieces that a hit is checked with before the whole item is.
CHECKS = 2

FOUND = "item_id {item}, distance int, start int, end int, item_chars int"


def normal(text: str) -> str:
    """Lower case, and white space as one space; offsets refer to this form."""
    return " ".join(text.lower().split())


def last_row(pattern: str, text: str) -> Iterator[int]:
    """Myers' bit-parallel search: after each character of ``text``, the least edit distance
    between ``pattern`` and any stretch of text that ends there."""
    size = len(pattern)
    where: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        where[c] |= 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    get = where.get
    for c in text:
        eq = get(c, 0)
        vertical = eq | down
        horizontal = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(horizontal | up))
        minus = up & horizontal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = minus | (full & ~(vertical | plus))
        down = plus & vertical
        yield score


def best_match(item: str, text: str, budget: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the closest stretch within the budget; of equals the first to
    end, and then the shortest."""
    least, end = budget + 1, 0
    for i, score in enumerate(last_row(item, text)):
        if score < least:
            least, end = score, i + 1
    if least > budget:
        return None
    begin = max(0, end - len(item) - budget)
    for i, score in enumerate(last_row(item[::-1], text[begin:end][::-1])):
        if score == least:
            return least, end - i - 1, end
    return least, end, end


def within(pattern: str, text: str, errors: int) -> bool:
    """Whether some stretch of the text is at most ``errors`` edits from the pattern."""
    return any(score <= errors for score in last_row(pattern, text))


def stands_alone(text: str, start: int, end: int) -> bool:
    """Whether no letter or digit goes on beyond either end of a stretch of text."""
    before = start > 0 and text[start - 1].isalnum() and text[start].isalnum()
    return not before and not (end < len(text) and text[end].isalnum() and text[end - 1].isalnum())


def groups(count: int) -> list[list[tuple[int, int]]]:
    """For each of ``count`` pieces, the groups (first, end) around it, smallest first."""
    around: list[list[tuple[int, int]]] = [[] for _ in range(count)]

    def halve(first, end):
        if end - first < 2:
            return
        middle = (first + end) // 2
        halve(first, middle)
        halve(middle, end)
        for k in range(first, end):
            around[k].append((first, end))

    halve(0, count)
    return around


class Matcher:
    """Finds items of one block in texts. Items too short for an edit have to stand at word edges."""

    def __init__(self, items: list[tuple], chars_per_edit: int):
        import ahocorasick

        self.items = items
        self.budgets = [len(text) // chars_per_edit for _, text in items]
        places = defaultdict(list)
        for n, ((_, text), budget) in enumerate(zip(items, self.budgets)):
            cuts = [len(text) * k // (budget + 1) for k in range(budget + 2)]
            for k, around in enumerate(groups(budget + 1)):
                # A check is a stretch of the item, the edits it may have, and how far the piece is
                # into it.
                checks = tuple(
                    (cuts[a], cuts[b], b - a - 1, cuts[k] - cuts[a]) for a, b in around[:CHECKS]
                )
                places[text[cuts[k]:cuts[k + 1]]].append((n, cuts[k], checks))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """For each item with a piece in the text that passes its checks, the merged stretches it could cover."""
        spans: dict[int, list[list[int]]] = {}
        for last, (size, found) in self.automaton.iter(text):
            for n, offset, checks in found:
                at = last + 1 - size
                budget, item = self.budgets[n], self.items[n][1]
                if not budget and not stands_alone(text, at, last + 1):
                    continue
                if not all(
                    within(item[i:j], text[max(0, at - back - e):at - back + j - i + e], e)
                    for i, j, e, back in checks
                ):
                    continue
                start = at - offset
                begin, end = start - budget, start + len(item) + budget
                spans.setdefault(n, []).append([max(0, begin), min(len(text), end)])
        for n, own in spans.items():
            own.sort()
            merged = [own[0]]
            for begin, end in own[1:]:
                if begin <= merged[-1][1]:
                    merged[-1][1] = max(end, merged[-1][1])
                else:
                    merged.append([begin, end])
            spans[n] = merged
        return spans

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, start, end): the best match of every item that is in the text."""
        if not self.items:
            return
        text = normal(text)
        for n, spans in sorted(self.windows(text).items()):
            best = None
            for begin, end in spans:
                found = best_match(self.items[n][1], text[begin:end], self.budgets[n])
                if found and (best is None or found[0] < best[0]):
                    best = found[0], begin + found[1], begin + found[2]
            if best:
                yield n, *best

    def any(self, text: str) -> bool:
        return next(self.find(text), None) is not None


def item_blocks(items: DataFrame, text: str, key: str) -> Iterator[list[tuple]]:
    """The items with text, normalised, in blocks whose size does not grow with their number. A block
    is made when it is asked for, so that only one is held.

    The caller goes through all documents once for each block.
    """
    rows = items.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-chars // BLOCK_CHARS)
    block = F.pmod(F.xxhash64("key", "text"), F.lit(max(1, count)))
    for b in range(count):
        found = [(r.key, normal(r.text or "")) for r in rows.where(block == b).collect()]
        if own := [x for x in found if x[1]]:
            yield own


def _matcher(shared, chars_per_edit: int) -> Matcher:
    """A broadcast block's matcher, built once in a worker process."""
    return kept("matcher", (shared.id, chars_per_edit), lambda: Matcher(shared.value, chars_per_edit))


class _Block:
    """A block of items that all tasks get, by a name of its own."""

    def __init__(self, spark, items: list[tuple]):
        self.id, self._sent = uuid.uuid4().hex, spark.sparkContext.broadcast(items)

    @property
    def value(self) -> list[tuple]:
        return self._sent.value

    def done(self) -> None:
        self._sent.unpersist()


def matches(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_key: str = "item_id",
    chars_per_edit: int = CHARS_PER_EDIT,
) -> DataFrame:
    """One row for each row of ``docs`` and item that it holds with at most one edit for each
    ``chars_per_edit`` characters of the item: key, item_id, distance, start, end, item_chars.

    The closest place is given, of equals the first, as an offset into the lower-cased text with
    single spaces. Items without text are in no document, and documents without text hold no item.
    An item shorter than ``chars_per_edit`` has to be found unchanged, and at word edges. Repeated
    rows and repeated items are all reported. An empty table gives no rows. Other columns are not
    read; where the result's names clash, the later one gets an underscore.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    keyed = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    key_type = keyed.schema["key"].dataType.simpleString()
    item_type = items.schema[item_key].dataType
    schema = f"key {key_type}, " + FOUND.format(item=item_type.simpleString())
    arrow_item = to_arrow_type(item_type)
    names = ["key", "item_id", "distance", "start", "end", "item_chars"]

    def search(shared):
        def run(batches):
            matcher = _matcher(shared, chars_per_edit)
            for batch in slices(batches, "text"):
                keys = batch.column("key").to_pylist()
                rows = [
                    (k, matcher.items[n][0], d, i, j, len(matcher.items[n][1]))
                    for k, t in zip(keys, strings(batch, "text"))
                    for n, d, i, j in matcher.find(t)
                ]
                columns = list(zip(*rows)) if rows else [[]] * 6
                types = [batch.schema.field("key").type, arrow_item, *[pa.int32()] * 4]
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=names
                )

        return run

    found, waiting = None, None
    for block in item_blocks(items, text, item_key):
        if waiting is not None:
            # There is another block, so the one before is finished first.
            found = _joined(found, staged(waiting[0], "contaminated"))
            waiting[1].done()
        shared = _Block(spark, block)
        waiting = keyed.mapInArrow(search(shared), schema), shared
    if waiting is None:
        found = spark.createDataFrame([], schema)
    else:
        found = _joined(found, waiting[0])
    return found.toDF(*unlike([key, *names[1:]]))


def _joined(found: DataFrame | None, part: DataFrame) -> DataFrame:
    return part if found is None else found.union(part)


def cleaned(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    chars_per_edit: int = CHARS_PER_EDIT,
) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns, whatever their names.

    Null and empty texts hold nothing and stay; repeated rows go or stay together; an empty table
    gives no rows, and without items all rows stay. With several blocks of items the rows that are
    left are written between them.
    """
    spark = docs.sparkSession

    def keep(shared):
        def build():
            matcher = _matcher(shared, chars_per_edit)

            def run(batch):
                return batch.filter(pa.array([not matcher.any(t) for t in strings(batch, text)]))

            return run

        return build

    waiting = None
    for block in item_blocks(items, text, item_key):
        if waiting is not None:
            docs = staged(docs, "decontaminated")
            waiting.done()
        waiting = _Block(spark, block)
        docs = map_text(docs, text, docs.schema, keep(waiting))
    return docs
