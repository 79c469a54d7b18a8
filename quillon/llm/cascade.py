"""Quality rules as a short-circuit cascade, ordered by rejection per cost on a sample."""

from __future__ import annotations

import functools
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows on which costs and rejections are estimated, whatever the table's size.
SAMPLE_ROWS = 10_000
WINDOW = 5
_SPACE = bytes([0x20, *range(0x09, 0x0E)])
_SYMBOLS = b"#*$%&|<>"


class Page:
    """A text and its measures, each worked out when a rule first asks for it."""

    def __init__(self, data: bytes | None):
        self.data = data or b""

    @functools.cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @functools.cached_property
    def n_words(self) -> int:
        return len(self.words)

    @functools.cached_property
    def word_chars(self) -> int:
        """Code points in words: bytes that don't continue a character, less white space."""
        signs = np.frombuffer(self.data, np.uint8)
        return int(np.count_nonzero((signs & 0xC0) != 0x80)) - sum(map(self.data.count, _SPACE))

    @functools.cached_property
    def n_symbols(self) -> int:
        return sum(map(self.data.count, _SYMBOLS))

    @functools.cached_property
    def lines(self) -> list[bytes]:
        """Lines that hold a word."""
        return [line for line in self.data.split(b"\n") if line.strip()]

    @functools.cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @functools.cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: Sequence[bytes], window: int = WINDOW) -> int:
    """Words that stand in a run of ``window`` words which the text holds twice or more.

    Runs are compared exactly: runs of one word more are numbered by (number of the run,
    number of the next word), so equal numbers are equal runs.
    """
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    runs, counts = ids, None
    for i in range(1, window):
        if len(words) - i < 2:
            return 0
        distinct, runs, counts = np.unique(
            runs[:-1] * len(known) + ids[i:], return_inverse=True, return_counts=True)
        if len(distinct) == len(runs):
            return 0
    covered = np.zeros(len(words), bool)
    again = (counts if counts is not None else np.bincount(runs))[runs] > 1
    for i in range(window):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    """A named test that tells whether a page is rejected."""

    name: str
    rejects: Callable[[Page], bool]


#: Rules whose failure is reported as such.
BASE = (
    Rule("few_words", lambda p: p.n_words < 10),
    Rule("repeated_words", lambda p: 100 * p.n_repeat_words > 20 * p.n_words),
)
#: Thresholds of the verdict, wide enough for running text of any language written with spaces.
RULES = (
    *BASE,
    Rule("symbols", lambda p: 10 * p.n_symbols > p.n_words),
    Rule("word_length", lambda p: not 2 * p.n_words <= p.word_chars <= 15 * p.n_words),
    Rule("repeated_lines", lambda p: 2 * p.n_dup_lines > len(p.lines)),
)


def _tried(batches: Iterator[pa.RecordBatch], rules: Sequence[Rule]) -> Iterator[pa.RecordBatch]:
    """Per set of rejecting rules (as bits): rows and the nanoseconds each rule took on them."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for text in batch.column(0):
            data, bits, spent = text.as_py(), 0, np.zeros(len(rules) + 1, np.int64)
            spent[-1] = 1
            for i, rule in enumerate(rules):
                page, start = Page(data), time.perf_counter_ns()
                bits |= bool(rule.rejects(page)) << i
                spent[i] = time.perf_counter_ns() - start
            held[bits] = held.get(bits, 0) + spent
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.int64()), pa.array([int(v[-1]) for v in held.values()], pa.int64()),
         pa.array([v[:-1].tolist() for v in held.values()], pa.list_(pa.int64()))], names=["bits", "n", "spent"])


def ranked(patterns: Sequence[tuple[int, int, Sequence[float]]], n_rules: int) -> list[int]:
    """Order of the rules by rejection per cost among the rows that earlier ones leave.

    ``patterns`` are (bits of the rejecting rules, rows, cost of each rule on these rows).
    Ties go to the rule that is named first.
    """
    order: list[int] = []
    while len(order) < n_rules:
        gone = sum(1 << i for i in order)
        alive = [p for p in patterns if not p[0] & gone]

        def worth(i: int) -> float:
            cost = sum(p[2][i] for p in alive)
            return sum(p[1] for p in alive if p[0] >> i & 1) / cost if cost else 0.0

        order.append(max((i for i in range(n_rules) if i not in order), key=lambda i: (worth(i), -i)))
    return order


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, text_column: str = "text") -> list[int]:
    """Order in which to try the rules, from about ``sample_rows`` random rows.

    A rule's cost is the time it takes alone on a sampled row. The order decides how much
    work the cascade does and which rule is named first, never which rows it keeps. At most
    one row for each set of rules and of the sample comes to the driver.
    """
    if len(rules) > 62:
        raise ValueError("at most 62 rules")
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.select(F.col(f"`{text_column}`").cast("binary").alias("text")).sample(share, seed=42)
    tried = sample.mapInArrow(functools.partial(_tried, rules=rules), "bits long, n long, spent array<long>")
    spent = [F.sum(F.col("spent")[i]).cast("double").alias(f"c{i}") for i in range(len(rules))]
    rows = tried.groupBy("bits").agg(F.sum("n").alias("n"), *spent).collect()
    return ranked([(r.bits, r.n, [r[f"c{i}"] for i in range(len(rules))]) for r in sorted(rows)], len(rules))


def _judged(batches: Iterator[pa.RecordBatch], rules: Sequence[Rule], measures: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by, found = [], {m: [] for m in measures}
        for text in batch.column(1):
            page = Page(text.as_py())
            by.append(next((rule.name for rule in rules if rule.rejects(page)), None))
            for m in measures:
                found[m].append(getattr(page, m))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(by, pa.string()), *(pa.array(found[m], pa.int64()) for m in measures)],
            names=["row", "rejected_by", *measures])


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES, order: Sequence[int] | None = None,
           measures: Sequence[str] = (), text_column: str = "text", columns: Sequence[str] | None = None) -> DataFrame:
    """(row, rejected_by, measures...): each row, as a struct, and the rule that stopped it.

    Rules are tried in ``order`` (estimated where it is not given) until one rejects the
    row; a row that passes all has a null. A rule works out the measures it needs, and
    measures already there are used again; those named in ``measures`` are returned for
    every row, whatever stopped it. ``columns`` are the columns kept in ``row``, all by
    default. One pass without a shuffle.

    A null text is an empty one: no words, no lines, rejected as too short. Equal rows are
    judged alike and all returned; ids play no part. An empty table gives no rows.
    """
    tried = list(order) if order is not None else estimate(docs, rules, text_column=text_column)
    row = F.struct(*(F.col(f"`{c}`") for c in (docs.columns if columns is None else columns))).alias("row")
    rows = docs.select(row, F.col(f"`{text_column}`").cast("binary").alias("_text"))
    schema = rows.select("row", F.lit(None).cast("string").alias("rejected_by"), *(F.lit(0).cast("long").alias(m) for m in measures)).schema
    body = functools.partial(_judged, rules=[rules[i] for i in tried], measures=list(measures))
    return rows.mapInArrow(body, schema)


def accepted(docs: DataFrame, rules: Sequence[Rule] = RULES, **options) -> DataFrame:
    """``docs`` without the rows that a rule rejects."""
    return judged(docs, rules, **options).where("rejected_by IS NULL").select("row.*")


def quality_rules(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)."""
    found = judged(docs, RULES, measures=MEASURES, columns=["doc_id"], **options)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.select("row.doc_id", *MEASURES, base.alias("base_failed"), F.col("rejected_by").isNull().alias("kept"))
