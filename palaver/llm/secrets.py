"""Secret scans: all rules in one automaton, one pass over the bytes.

The rules are compiled together (see `automaton`).  A batch's bytes are cut into a few thousand lanes
of about equal length at bytes that bring every state back to the start, and all lanes advance in
lockstep: one byte each a step, one table look-up for all rules.  Where a state accepts, the rule's own
small automata give the span: backward to the leftmost start, forward to the longest end.

Each rule's matches are leftmost and do not overlap; one shorter than the rule's least length is
dropped after it has taken its place; spans that start together are in the order of the rules.  Null is read as
empty; texts of any length are scanned whole; rows that repeat are scanned one by one; an empty table gives no
rows.  A column that is named as the result (`into`) is replaced, others are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.automaton import Automaton, compile_rules
from palaver.llm.common import Shared
from palaver.llm.kernel import slices, string_bytes


@dataclass(frozen=True)
class Rule:
    """`least`: characters that the part after `head` needs; `head` is a pattern for what goes before it."""

    kind: str
    head: str
    body: str
    least: int = 0


#: Kinds in the order in which equal starts are listed.  The heads end where the bodies begin.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=\-]+", 12),
    Rule("access", r"", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"", r"[0-9a-f]{16,}", 16),
    Rule("pem", r"", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----"),
    Rule("forge", r"", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("chat", r"", r"xox[abprs]-[A-Za-z0-9\-]+", 20),
    Rule("jwt", r"", r"eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+", 40),
)
LANES = 4096
FEW = 12


class Scanner:
    """The compiled rules: the combined search automaton and each rule's walkers."""

    def __init__(self, rules=RULES):
        whole = [r.head + r.body for r in rules]
        self.rules = rules
        self.search = compile_rules(whole)
        self.forward = [compile_rules([w], search=False) for w in whole]
        self.backward = [compile_rules([w], search=False, backward=True) for w in whole]
        self.heads = [compile_rules([r.head], search=False) if r.head else None for r in rules]

    def events(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions whose byte leads to an accepting state, ascending, and the states' rules."""
        auto = self.search
        size = max(64, len(data) // LANES)
        resets = np.flatnonzero(auto.resets[data])
        wanted = np.searchsorted(resets, np.arange(size, len(data), size))
        cuts = np.unique(np.concatenate(([0], resets[wanted[wanted < len(resets)]] + 1, [len(data)])))
        length = np.diff(cuts)
        order = np.argsort(-length, kind="stable")
        start, length = cuts[:-1][order], length[order]
        state, steps = np.zeros(len(start), np.int64), int(length[0]) if len(length) else 0
        active = np.searchsorted(-length, -np.arange(steps), "left")
        classes, found, masks, t = auto.classes[data], [], [], 0
        while t < steps and active[t] > FEW:
            n = active[t]
            at = start[:n] + t
            state = auto.table[state[:n] + classes[at]]
            if state.max() >= auto.accepts_from:
                hit = np.flatnonzero(state >= auto.accepts_from)
                found.append(at[hit])
                masks.append(auto.rules[state[hit] // auto.n_classes])
            t += 1
        if t < steps:  # a few long lanes are left: walk each
            table = auto.table.tolist()
            for lane in range(int(active[t])):
                s, base = int(state[lane]), int(start[lane])
                for i, c in enumerate(classes[base + t : base + int(length[lane])].tolist(), base + t):
                    s = table[s + c]
                    if s >= auto.accepts_from:
                        found.append(np.array([i]))
                        masks.append(auto.rules[[s // auto.n_classes]])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, mask = np.concatenate(found), np.concatenate(masks)
        order = np.argsort(at, kind="stable")
        return at[order], mask[order]

    @staticmethod
    def walk(auto: Automaton, data: bytes, at: int, stop: int, step: int) -> int:
        """The last position before which the automaton accepts, walking from `at` to `stop`; -1 if none."""
        state, last = 0, at if auto.rules[0] else -1
        table, classes, accepts, dead = auto.plain
        # from the byte at `at` on, or from the one before it backward
        for i in range(at, stop) if step > 0 else range(at - 1, stop - 1, -1):
            state = table[state + classes[data[i]]]
            if state >= accepts:
                last = i + (step > 0)
            elif state == dead:
                break
        return last

    def spans(self, data: bytes, events: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """Spans (start, rule, end) in bytes of one text, from its accepting positions."""
        out, resume = [], [0] * len(self.rules)
        for at, mask in events:
            for k, rule in enumerate(self.rules):
                if not mask >> k & 1 or at < resume[k]:
                    continue
                start = self.walk(self.backward[k], data, at + 1, resume[k], -1)
                if start < 0:
                    continue
                end = self.walk(self.forward[k], data, start, len(data), 1)
                resume[k] = end
                body = self.walk(self.heads[k], data, start, end, 1) if self.heads[k] else start
                if end - body >= rule.least:
                    out.append((start, k, end))
        return sorted(out)

    def scan(self, data: np.ndarray, off: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """Spans of every text that has any, in bytes from the text's start."""
        # a line feed after every text: no rule crosses one
        parted = np.insert(data, off[1:], 10)
        off = off + np.arange(len(off))
        at, mask = self.events(parted)
        if not len(at):
            return {}
        doc = np.searchsorted(off, at, "right") - 1
        found, edges = {}, np.flatnonzero(np.diff(doc, prepend=-1))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(doc)], strict=True):
            d = int(doc[a])
            base = int(off[d])
            if spans := self.spans(parted[base : off[d + 1] - 1].tobytes(), list(zip((at[a:b] - base).tolist(), mask[a:b].tolist(), strict=True))):
                found[d] = spans
        return found


#: Compiled rule sets of this process.
COMPILED: dict[tuple, Scanner] = {}


def compiled(rules: tuple) -> Scanner:
    if rules not in COMPILED:
        COMPILED[rules] = Scanner(rules)
    return COMPILED[rules]


def _points(data: np.ndarray, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans in code points."""
    before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return [(int(before[a]), k, int(before[b])) for a, k, b in spans]


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def find(docs: DataFrame, *, text_col: str = "text", into: str = "secrets", rules=RULES) -> DataFrame:
    """The documents with a column of spans in code points, ordered by start and kind."""
    scanner = Shared(docs.sparkSession, compiled(tuple(rules)))
    schema = docs.drop(into).withColumn(into, F.lit(None).cast(SPANS)).schema
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text_col):
                data, off = string_bytes(batch.column(text_col))
                rows = [[] for _ in range(batch.num_rows)]
                for d, spans in scanner.value.scan(data, off).items():
                    rows[d] = [{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in _points(data[off[d] : off[d + 1]], spans)]
                names = [n for n in batch.schema.names if n != into]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(rows, kind)], names=[*names, into])

    return docs.drop(into).mapInArrow(run, schema)


def digest(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules=RULES, base=("assign", "access", "hex")) -> DataFrame:
    """One row a document: counts of the base kinds, digest of their spans, all spans as text."""
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    found = find(docs.select(id_col, text_col), text_col=text_col, rules=rules)
    own = F.filter("secrets", lambda s: s["kind"].isin(*base))
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        id_col, *(of(k).alias(f"n_{k}") for k in base),
        F.sha2(F.array_join(F.transform(own, line), ","), 256).alias("base_sha256"), F.array_join(F.transform("secrets", line), ",").alias("spans"),
    )


def _covered(data: bytes, spans: list[tuple[int, int, int]], rules) -> str:
    """The text with its spans, in bytes and in order of start, replaced by their kinds; each piece is copied once."""
    out, upto = [], 0
    for start, k, end in spans:
        if start >= upto:
            out += [data[upto:start], f"<{rules[k].kind}>".encode()]
        upto = max(upto, end)
    return b"".join([*out, data[upto:]]).decode()


def redact(docs: DataFrame, *, text_col: str = "text", rules=RULES) -> DataFrame:
    """The documents with every secret replaced by its kind in angle brackets; overlapping spans become one."""
    scanner = Shared(docs.sparkSession, compiled(tuple(rules)))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text_col):
                column = batch.column(text_col)
                data, off = string_bytes(column)
                found = scanner.value.scan(data, off)
                if found:
                    texts = column.to_pylist()
                    for d, spans in found.items():
                        texts[d] = _covered(data[off[d] : off[d + 1]].tobytes(), spans, rules)
                    column = pa.array(texts, column.type)
                yield pa.RecordBatch.from_arrays([column if n == text_col else batch.column(n) for n in batch.schema.names], names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
