"""Secrets in texts: fixed patterns, plus format likelihood under inferred probabilistic automata.

What the fixed patterns find are the labelled credentials, by kind. For each kind a bounded sample of
distinct ones becomes a prefix tree over character classes; states whose observed continuations agree
(Hoeffding bound on every continuation, recursively) are merged, which leaves a small probabilistic
automaton. Its states come from the first ``TREE_DEPTH`` characters of the strings, its counts from a walk of
the whole strings. Candidates are all other runs of ``LEAST_RUN`` or more credential characters, and what of
a run lies outside base spans. They are scored by their log likelihood per character under the best
automaton against automata inferred from ordinary candidates, short ones and long ones apart. Those that
beat both by ``MARGIN`` and are as typical of the kind as its own sample become spans of kind ``format``.

Texts are read twice. The first pass keeps, of each kind, the ``SAMPLE`` distinct strings with the smallest
checksum in each task, so the smallest of all documents are among them; the second scores every candidate.
A text costs time linear in its spans and candidates (both are sorted, and merged).

Defined results: a null text counts as empty; ids may be null or repeated (each row is scanned);
an empty table gives an empty result; with nothing to learn from, there are only base spans; other
columns are ignored; positions count code points.
"""

from __future__ import annotations

import heapq
import json
import math
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, discard, ship, written

#: The base patterns by kind, in their order, and the least length that counts.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "format")
#: Candidate strings: runs of credential characters, as short as the shortest labelled credential.
LEAST_RUN = min(LEAST.values())
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}")
#: Ordinary candidates of this length on are long ones, with an automaton of their own.
LONG = 16
ORDINARY = ("short", "long")
#: Sampled strings per kind that an automaton is inferred from, at most.
SAMPLE = 1500
#: Characters of a sampled string that enter the prefix tree (the counts come from whole strings).
TREE_DEPTH = 64
#: Confidence parameter of the state merging test.
ALPHA = 0.01
#: Log likelihood per character by which a credential format must beat ordinary text.
MARGIN = 0.25
#: A candidate's rate lies between these quantiles of the kind's own sample, but for a slack below (shorter strings
#: pay more for their end). More likely than nearly all of the sample is untypical too: a word in capitals, say.
TYPICAL, BELOW = (0.02, 0.98), 0.15
#: Ways (distinct strings) that a kind must have been seen, to be learned.
LEAST_SAMPLE = 5
#: Fixed value: the class of a character.
CLASSES = "".join("d" if 48 <= c < 58 else "h" if chr(c) in "abcdef" else "H" if chr(c) in "ABCDEF"
                  else "l" if 97 <= c < 123 else "U" if 65 <= c < 91 else "s" for c in range(128))
_CLASS = str.maketrans({c: k for c, k in enumerate(CLASSES)})
_END = "$"
#: Class strings whose scores a task remembers, at most.
REMEMBERED = 200_000


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base matches of all kinds, ordered by start and then kind."""
    found = []
    low = text.casefold() if not text.isascii() else text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [("hex", m.start(), m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found, key=_place)


_LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")


def _place(span: tuple[str, int, int]) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def classes(value: str) -> str:
    return value.translate(_CLASS)


def candidates(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Places of the runs, and parts of runs, outside the base spans (which are ordered by start)."""
    covered: list[list[int]] = []
    for _, a, b in base:
        if covered and a <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], b)
        else:
            covered.append([a, b])
    at = 0
    for m in CANDIDATE.finditer(text):
        start, stop = m.span()
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        while at < len(covered) and covered[at][0] < stop:
            if covered[at][0] - start >= LEAST_RUN:
                yield start, covered[at][0]
            start = covered[at][1]
            if start > stop:  # this span reaches into the next run
                break
            at += 1
        if stop - start >= LEAST_RUN:
            yield start, stop


class Automaton:
    """Counts of a deterministic probabilistic automaton: for each state, how often each character
    class led where, and how often a string ended."""

    def __init__(self, moves: list[dict[str, list[int]]]):
        self.moves = moves  # state -> symbol -> [target, count]
        self._logs: list[tuple[dict[str, tuple[int, float]], tuple[int, float]]] | None = None

    @staticmethod
    def tree(words: list[str]) -> Automaton:
        moves: list[dict[str, list[int]]] = [{}]
        for w in words:
            state = 0
            for symbol in [*w, _END] if len(w) <= TREE_DEPTH else w[:TREE_DEPTH]:
                if symbol not in moves[state]:
                    moves[state][symbol] = [len(moves), 0]
                    moves.append({})
                step = moves[state][symbol]
                step[1] += 1
                state = step[0]
        return Automaton(moves)

    def total(self, state: int) -> int:
        return sum(n for _, n in self.moves[state].values())

    def compatible(self, p: int, q: int) -> bool:
        """Whether all continuations of the two states agree within the Hoeffding bound."""
        queue = [(p, q)]
        while queue:
            p, q = queue.pop()
            n, m = self.total(p), self.total(q)
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            for symbol in self.moves[p].keys() | self.moves[q].keys():
                x, y = self.moves[p].get(symbol), self.moves[q].get(symbol)
                if abs((x[1] if x else 0) / n - (y[1] if y else 0) / m) > bound:
                    return False
                if x and y and symbol != _END:
                    queue.append((x[0], y[0]))
        return True

    def fold(self, keep: int, gone: int) -> None:
        """Add the counts of the tree below ``gone`` to the automaton at ``keep``."""
        queue = [(keep, gone)]
        while queue:
            p, q = queue.pop()
            for symbol, (target, n) in self.moves[q].items():
                if symbol in self.moves[p]:
                    self.moves[p][symbol][1] += n
                    if self.moves[p][symbol][0] != target:
                        queue.append((self.moves[p][symbol][0], target))
                else:
                    self.moves[p][symbol] = [target, n]

    def infer(self) -> Automaton:
        """Merge compatible states: states are settled in breadth-first order, and each next one is
        folded into the first settled state it agrees with."""
        settled, seen = [0], {0}
        while True:
            border = [(p, s, t) for p in settled for s, (t, _) in sorted(self.moves[p].items()) if t not in seen and s != _END]
            if not border:
                break
            p, symbol, state = max(border, key=lambda b: (self.moves[b[0]][b[1]][1], -b[2]))
            for r in settled:
                if self.compatible(r, state):
                    self.moves[p][symbol][0] = r
                    self.fold(r, state)
                    break
            else:
                settled.append(state)
                seen.add(state)
        names = {s: i for i, s in enumerate(settled)}
        return Automaton([{a: [names.get(t, 0), n] for a, (t, n) in self.moves[s].items()} for s in settled])

    def recount(self, words: list[str]) -> Automaton:
        """The same states, with the counts of a walk of the whole ``words``; continuations not seen before lead to the start."""
        moves: list[dict[str, list[int]]] = [{a: [t, 0] for a, (t, _) in each.items()} for each in self.moves]
        for word in words:
            state = 0
            for symbol in [*word, _END]:
                step = moves[state].setdefault(symbol, [0, 0])
                step[1] += 1
                state = step[0]
        return Automaton(moves)

    def rate(self, word: str) -> float:
        """Log likelihood per symbol, the end included; symbols never seen count half a time."""
        if self._logs is None:
            totals = [self.total(s) + 4 for s in range(len(self.moves))]
            self._logs = [({a: (t, math.log((c + 0.5) / n)) for a, (t, c) in each.items()}, (0, math.log(0.5 / n))) for each, n in zip(self.moves, totals)]
        state, total = 0, 0.0
        for symbol in word + _END:
            known, unseen = self._logs[state]
            state, log = known.get(symbol, unseen)
            total += log
        return total / (len(word) + 1)


class Scorer:
    """Scores class strings under the learned automata, remembering those met before."""

    def __init__(self, automata: dict[str, tuple[list, float, float]], margin: float):
        self.plain = [Automaton(automata[k][0]) for k in ORDINARY if k in automata]
        self.kinds = [(Automaton(m), least, most) for k, (m, least, most) in automata.items() if k not in ORDINARY]
        self.ready = bool(self.plain and self.kinds)
        self.margin = margin
        self.known: dict[str, tuple[float, bool]] = {}

    def score(self, word: str) -> tuple[float, bool]:
        """By how much a credential format is likelier than ordinary text, and whether that makes a span."""
        found = self.known.get(word)
        if found is None:
            rates = [(a.rate(word), least, most) for a, least, most in self.kinds]
            score = max(r for r, _, _ in rates) - max(a.rate(word) for a in self.plain)
            found = score, score >= self.margin and any(least <= r <= most for r, least, most in rates)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = found
        return found


def _checksum(value: str) -> tuple[int, str]:
    return zlib.crc32(value.encode()), value


def _least(values: set[str], bound: int) -> set[str]:
    return values if len(values) <= bound else set(heapq.nsmallest(bound, values, key=_checksum))


def samples(docs: DataFrame, text_col: str = "text", bound: int = SAMPLE) -> DataFrame:
    """``kind, value``: for every kind, the distinct strings with the smallest checksums of each task."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, set[str]] = {k: set() for k in (*KINDS[:3], *ORDINARY)}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                spans = base_spans(text)
                for k, a, b in spans:
                    seen[k].add(ASSIGN.match(text, a)[2] if k == "assign" else text[a:b])
                for a, b in candidates(text, spans):
                    seen["short" if b - a < LONG else "long"].add(text[a:b])
                for k, values in seen.items():
                    if len(values) > 4 * bound:
                        seen[k] = _least(values, bound)
        rows = [(k, v) for k, values in seen.items() for v in sorted(_least(values, bound))]
        yield pa.RecordBatch.from_pydict({"kind": pa.array([k for k, _ in rows], pa.string()), "value": pa.array([v for _, v in rows], pa.string())})

    return columns(docs, F.col(text_col).cast("string").alias("text")).mapInArrow(run, "kind string, value string")


def learn(sampled: DataFrame) -> dict[str, tuple[list, float, float]]:
    """Automata and typical rates by kind, each inferred in a task from ``SAMPLE`` strings at most."""
    sample = None
    for kind in (*KINDS[:3], *ORDINARY):
        rows = sampled.where(F.col("kind") == kind).distinct()
        rows = rows.orderBy(F.crc32(F.col("value").cast("binary")), "value").limit(SAMPLE)  # SAMPLE strings per kind
        sample = rows if sample is None else sample.union(rows)

    def infer(key: tuple, table: pa.Table) -> pa.Table:
        words = sorted(classes(v) for v in table["value"].to_pylist())
        if len(words) < LEAST_SAMPLE:
            return pa.table({"kind": pa.array([], pa.string()), "moves": pa.array([], pa.string()), "least": pa.array([], pa.float64()), "most": pa.array([], pa.float64())})
        grown = Automaton.tree(words).infer().recount(words)
        rates = sorted(map(grown.rate, words))
        least, most = (rates[int(q * (len(rates) - 1))] for q in TYPICAL)
        return pa.table({"kind": [key[0].as_py()], "moves": [json.dumps(grown.moves)], "least": [least - BELOW], "most": [most]})

    found = sample.groupBy("kind").applyInArrow(infer, "kind string, moves string, least double, most double").collect()  # five automata
    return {r["kind"]: (json.loads(r["moves"]), r["least"], r["most"]) for r in found}


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """Per row: id, counts by base kind, ``base_spans`` and all ``spans`` as ``kind:start:end``, and the best score of a candidate."""
    spark = docs.sparkSession
    sampled = written(spark, samples(docs, text_col), "secret-samples")
    automata = learn(sampled)
    discard(sampled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(automata, margin)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                spans, best = list(base), None
                for start, stop in candidates(text, base) if scorer.ready else ():
                    score, found = scorer.score(classes(text[start:stop]))
                    best = score if best is None or score > best else best
                    if found:
                        spans.append(("format", start, stop))
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
                rows.append((*counts, joined(base), joined(sorted(spans, key=_place)), best))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans", "best_format"]
            cols = [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=names)

    rows = columns(docs, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string, best_format double")


def digest(found: DataFrame) -> DataFrame:
    """The spans' digest columns."""
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans", "best_format")


