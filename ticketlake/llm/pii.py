"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Generators with high recall propose overlapping spans of text: strict ones (e-mail, IP, card and phone formats) and loose
ones (spelled-out addresses, long digit groups, hexadecimal addresses, account numbers). Spans that pass the strict
formats are kept as they are. For the others, gradient-boosted trees score features of the format (length, digits,
separators, checksum) and of the words around; a threshold per kind, set on spans that did not train, selects what
is added.

The trees learn from the strict formats: positives are spans that pass them, negatives those that fail, and the features
leave out the test itself where it would give the answer away. They are fitted on every text: equal feature vectors fold
to one with its count, tasks add up the histograms of a level, and only these sums reach the driver.

Null and empty texts have no spans. Repeated rows get equal spans. Without positives and negatives nothing is added.
Spans are in code points, end exclusive; equal spans of several kinds all stay.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.llm.common import blocks
from ticketlake.session import settle

#: Kinds in the order in which spans are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
LOOSE_KINDS = ("address", "network", "number", "contact")
#: Strict kinds whose span the trees add under a name of its own, as base spans are listed by themselves.
ADDED = {kind: f"{kind}_like" for kind in BASE_KINDS}
_ORDER = {kind: k for k, kind in enumerate((*BASE_KINDS, *ADDED.values(), *LOOSE_KINDS))}
#: Trees and their depth, bins of a feature; the precision that a threshold must reach.
TREES, DEPTH, BINS, PRECISION = 12, 3, 24, 0.99
LEAST_PROBABILITY = 0.8
#: Slopes are summed as whole numbers of this size, so that sums do not depend on the order of tasks.
_UNIT = float(1 << 24)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(r"[A-Za-z0-9._+-]{2,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{2,63} ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z]{2,12}")
_MAC = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){5}(?![0-9A-Fa-f:])")
_LONG = re.compile(r"(?<![0-9])[0-9](?:[ .()/-]?[0-9]){8,18}(?![0-9])")
_IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])")
_CUES = ("mail", "contact", "phone", "tel", "call", "card", "visa", "account", "ip", "host", "address", "ssn", "number", "iban")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From every @ to the left and to the right, so that a long run of letters costs one walk."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        last = found.end() if found else at + 1
        at = text.find("@", last)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """kind, start, end, and whether the strict format of the kind is met, of every proposed span."""
    out = [("email", a, b, True) for a, b in _emails(text)] if "@" in text else []
    if "." in text:
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            out.append(("ip", *m.span(), all(len(p) < 4 and int(p or 0) <= 255 for p in parts)))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 10 <= len(digits) <= 24:
            out.append(("card", *m.span(), 13 <= len(digits) <= 19 and luhn(digits)))
    if "+" in text:
        out += [("phone", *m.span(), 9 <= len(_digits(m.group())) <= 15) for m in _PHONE.finditer(text)]
    if "at)" in text or "at]" in text:
        out += [("address", *m.span(), False) for m in _SPELLED.finditer(text)]
    if ":" in text:
        out += [("network", *m.span(), False) for m in _MAC.finditer(text)]
    out += [("contact", *m.span(), False) for m in _LONG.finditer(text)]
    out += [("number", *m.span(), False) for m in _IBAN.finditer(text)]
    return out


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span and words around it; which kind's test it passed is left out."""
    span, before, after = text[start:end], text[max(0, start - 40) : start].lower(), text[end : end + 20].lower()
    digits = _digits(span)
    letters = sum(c.isalpha() for c in span)
    parts = re.split(r"[ .()/:-]+", span)
    return [
        float(len(span)), float(len(digits)), float(letters), float(span.count(".")), float(span.count("-")), float(span.count(" ")),
        float(span.count(":")), float("@" in span or "at" in span), float(span[:1] == "+"), float(len(parts)), float(max(map(len, parts))),
        float(min(map(len, parts))), float(len(digits) > 1 and luhn(digits)), float(all(p.isdigit() and int(p[:6]) < 256 for p in parts if p)),
        float(len(set(digits))), float(before[-1:].isalnum()), float(after[:1].isalnum()), float("\n" in before[-3:]),
        *[float(cue in before) for cue in _CUES],
    ]


class Trees:
    """Gradient-boosted regression trees for the log odds, split on quantiles of each feature."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, rate: float = 0.3, bins: int = BINS):
        self.count, self.depth, self.rate, self.bins = trees, depth, rate, bins
        self.prior, self.parts = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, self.bins + 1)[1:-1])) for k in range(x.shape[1])]
        once = np.ones(len(y), np.int64)
        return self.learn(cuts, float(y.mean()), lambda splits: level_sums(self, cuts, splits, x, y, once))

    def learn(self, cuts: list[np.ndarray], share: float, sums: Callable[[list], np.ndarray]) -> Trees:
        """Trees from the sums of slope, curvature and rows by node, feature and bin that `sums` gives for each level."""
        share = min(max(share, 1e-4), 1 - 1e-4)
        self.prior = float(np.log(share / (1 - share)))
        for _ in range(self.count):
            self.parts.append(self._grow(cuts, sums))
        return self

    def _grow(self, cuts: list[np.ndarray], sums: Callable[[list], np.ndarray]):
        splits: list = [None] * (1 << self.depth)  # by node, the children of i are 2i and 2i + 1
        value = [0.0] * (2 << self.depth)
        open_ = [1]
        for level in range(self.depth):
            if not open_:
                break
            g, h, n = sums(splits[: 1 << level])
            follow = []
            for node in open_:
                at = node - (1 << level)
                if level == 0:
                    value[node] = self._value(g[at, 0].sum(), h[at, 0].sum())
                found = self._best(cuts, g[at], h[at]) if n[at, 0].sum() >= 20 else None
                if found:
                    k, cut = found
                    splits[node] = (k, float(cuts[k][cut]))
                    for child, part in ((2 * node, slice(0, cut + 1)), (2 * node + 1, slice(cut + 1, None))):
                        value[child] = self._value(g[at, k, part].sum(), h[at, k, part].sum())
                        follow.append(child)
            open_ = follow

        def whole(node: int):
            if node >= len(splits) or splits[node] is None:
                return value[node]
            return (*splits[node], whole(2 * node), whole(2 * node + 1))

        return whole(1)

    def _value(self, slope: float, curve: float) -> float:
        return float(self.rate * slope / (curve + 1.0))

    def _best(self, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> tuple[int, int] | None:
        """Feature and cut of the split that gains most."""
        best = (1e-6, None)
        whole = g[0].sum() ** 2 / (h[0].sum() + 1.0)
        for k, cut in enumerate(cuts):
            if not len(cut):
                continue
            low, curve = g[k].cumsum()[: len(cut)], h[k].cumsum()[: len(cut)]
            gain = low**2 / (curve + 1.0) + (g[k].sum() - low) ** 2 / (h[k].sum() - curve + 1.0) - whole
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (float(gain[at]), (k, at))
        return best[1]

    def _walk(self, tree, x: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        k, cut, low, high = tree
        below, out = x[:, k] <= cut, np.empty(len(x))
        out[below], out[~below] = self._walk(low, x[below]), self._walk(high, x[~below])
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.prior + sum(self._walk(tree, x) for tree in self.parts))))


def _level_units(model: Trees, cuts: list[np.ndarray], splits: list, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Slope, curvature and rows in whole units, by node of the level below `splits`, feature and bin."""
    level, width = len(splits).bit_length() - 1, max(map(len, cuts)) + 1
    node = np.ones(len(x), np.int64)
    for _ in range(level):
        step = np.zeros(len(x), np.int64)
        for at, split in enumerate(splits):
            here = node == at
            if split:
                step[here] = 2 * at + (x[here, split[0]] > split[1])
        node = step  # 0: the row is in a leaf
    kept = node > 0
    x, y, n, node = x[kept], y[kept], n[kept], node[kept] - (1 << level)
    p = model.probability(x)
    weights = [np.rint((y - p) * _UNIT) * n, np.rint(p * (1 - p) * _UNIT) * n, n.astype(np.float64)]
    out = np.zeros((3, 1 << level, len(cuts), width), np.int64)
    for k, cut in enumerate(cuts):
        place = node * width + np.searchsorted(cut, x[:, k], "left")
        for total, weight in zip(out, weights, strict=True):
            total[:, k] = np.bincount(place, weight, width << level).astype(np.int64).reshape(1 << level, width)
    return out


def _in_ones(units: np.ndarray) -> np.ndarray:
    out = units.astype(np.float64)
    out[:2] /= _UNIT
    return out


def level_sums(model: Trees, cuts: list[np.ndarray], splits: list, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    return _in_ones(_level_units(model, cuts, splits, x, y, n))


def _vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), -1).astype(np.float64)


def training_rows(docs: DataFrame) -> DataFrame:
    """features (packed), strict, fold (0 to 4, by the span's text) and n, how many: every candidate of a strict kind in `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            found = Counter(
                (np.array(features(t, k, a, b), np.float32).tobytes(), s, zlib.crc32(t[a:b].encode()) % 5)
                for t in part.column("text").to_pylist() for k, a, b, s in candidates(t) if k in BASE_KINDS
            )
            if found:
                values, strict, folds = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, pa.binary()), pa.array(strict), pa.array(folds, pa.int32()), pa.array(found.values(), pa.int64())],
                    names=["features", "strict", "fold", "n"],
                )

    found = docs.where(F.col("text").isNotNull()).select("text").mapInArrow(run, "features binary, strict boolean, fold int, n bigint")
    return found.groupBy("features", "strict", "fold").agg(F.sum("n").alias("n"))


def _cuts(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """Values of each feature at which the rows, by their counts, pass into another of `bins` equal parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, n = _vectors(batch.column("features")), batch.column("n").to_numpy()
                for k in range(x.shape[1]):
                    values, place = np.unique(x[:, k], return_inverse=True)
                    counts = np.bincount(place, n).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), k, np.int32)), pa.array(values), pa.array(counts)], names=["k", "value", "n"])

    counted = rows.mapInArrow(run, "k int, value double, n bigint").groupBy("k", "value").agg(F.sum("n").alias("n"))
    feature = Window.partitionBy("k")
    upto, whole = F.sum("n").over(feature.orderBy("value")), F.sum("n").over(feature)
    passed = counted.select("k", "value", "n", upto.alias("upto"), whole.alias("whole")).where(
        f"least(upto * {bins} div whole, {bins - 1}) > (upto - n) * {bins} div whole"
    )
    found = [(r.k, r.value) for r in passed.select("k", "value").collect()]  # fewer than `bins` of each feature
    return [np.array(sorted(v for j, v in found if j == k)) for k in range(1 + max(j for j, _ in found))]


def fit(docs: DataFrame) -> tuple[Trees, float] | None:
    """The trees, and the least probability from which on PRECISION of the spans kept out of training are positive."""
    every = settle(training_rows(docs))
    rows, aside = every.where("fold > 0"), every.where("fold = 0")
    total, positive = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("strict").cast("int") * F.col("n")), F.lit(0))).first()
    if positive in (0, total):
        return None
    trees, cuts = Trees(), _cuts(rows, BINS)

    def sums(splits: list) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            units = 0
            for batch in batches:
                if batch.num_rows:
                    y, n = batch.column("strict").to_numpy(zero_copy_only=False).astype(np.float64), batch.column("n").to_numpy()
                    units = units + _level_units(trees, cuts, splits, _vectors(batch.column("features")), y, n)
            if np.ndim(units):
                flat = units.reshape(3, -1)
                place = np.flatnonzero(flat[2])
                yield pa.RecordBatch.from_arrays([pa.array(place), *map(pa.array, flat[:, place])], names=["place", "g", "h", "n"])

        added = rows.mapInArrow(run, "place bigint, g bigint, h bigint, n bigint").groupBy("place").agg(*[F.sum(c).alias(c) for c in "ghn"])
        units = np.zeros((3, len(splits), len(cuts), max(map(len, cuts)) + 1), np.int64)
        for r in added.collect():  # at most nodes x features x bins
            units.reshape(3, -1)[:, r.place] = r.g, r.h, r.n
        return _in_ones(units)

    trees.learn(cuts, positive / total, sums)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p, place = np.unique(trees.probability(_vectors(batch.column("features"))), return_inverse=True)
                n = batch.column("n").to_numpy()
                good = n * batch.column("strict").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p), *(pa.array(np.bincount(place, w, len(p)).astype(np.int64)) for w in (n, good))], names=["p", "n", "good"]
                )

    # One row per probability that the leaves can add up to, so the window is as small as the model.
    scored = aside.mapInArrow(score, "p double, n bigint, good bigint").groupBy("p").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    best = Window.orderBy(F.desc("p"))
    kept = scored.select("p", F.sum("n").over(best).alias("n"), F.sum("good").over(best).alias("good")).where(F.col("good") >= PRECISION * F.col("n"))
    least = kept.agg(F.min("p")).first()[0]
    return trees, 1.01 if least is None else max(least, LEAST_PROBABILITY)


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
SHAPE = "array<struct<kind:string,start:int,end:int>>"


def find(docs: DataFrame) -> DataFrame:
    """row (all columns) and spans: strict ones, and those that the trees add, by kind as listed, then start."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))  # a few small trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            found = [candidates(t) for t in part.column("text").to_pylist()]
            spans: list[list] = [[s for s in own if s[3]] for own in found]
            open_ = [(n, s) for n, own in enumerate(found) for s in own if not s[3]]
            if open_ and model.value:
                trees, threshold = model.value
                texts_of = {n: part.column("text")[n].as_py() for n in {n for n, _ in open_}}
                p = trees.probability(np.array([features(texts_of[n], *s[:3]) for n, s in open_]))
                for k in np.flatnonzero(p >= threshold):
                    n, (kind, a, b, _) = open_[k]
                    if not any(a < d and c < b for _, c, d, strict in spans[n] if strict):
                        spans[n].append((ADDED.get(kind, kind), a, b, False))
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b, _ in sorted(own, key=lambda s: (_ORDER[s[0]], s[1], s[2]))] for own in spans]
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(rows, pa.list_(_SPAN))], names=["row", "spans"])

    source = docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, spans {SHAPE}")


def redact(text: str, spans: list[tuple[int, int]], mark: str = "[removed]") -> str:
    """The text with spans replaced; spans that overlap become one mark."""
    out, at = [], 0
    for start, end in sorted(spans):
        if end > at:
            if start >= at:
                out += [text[at:start], mark]
            at = end
    return "".join([*out, text[at:]])
