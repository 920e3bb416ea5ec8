"""Toxic spans and document scores from a linear-chain conditional random field.

Tokens are runs of letters. Training labels are per document, so tokens are labelled first: a
feature (the word itself, or its first 4, 5 or 6 bytes) that stands in many more toxic than
other documents marks the tokens that have it in toxic documents. The field is fitted on these
labelled tokens: a weight for each marking feature, one for every token, and weights for
the transitions between both labels. Chains are lines.

Forward-backward marginals give the offending spans and, as the largest and the sum over a
document, its score through a logistic curve fitted on the training documents. A line without any
marking feature has marginals that depend on its length alone, which are computed once.

Fitted on at most ``LABELLED`` labelled documents of each kind, drawn by a hash; all texts are
scored whole. Defined results: a null or empty text has no tokens and gets the lowest score.
Null labels don't count; a document with both labels is toxic. Without toxic or without other
labels every score is 0. A null id is not held out. Rows that share an id are scored each by its own
text. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F, types as T

from remitspark.llm.common import arrow_schema, stored
from remitspark.llm.textarrays import BASE, NO_LETTER, Hasher, char_positions, mix, slices, text_bytes, word_bounds

#: Labelled documents of each kind that the model is fitted on, at most.
LABELLED = 2_000
PREFIXES = (4, 5, 6)
#: How much more often a marking feature stands in toxic documents, and the evidence it takes in nats.
RATIO = 20.0
EVIDENCE = 12.0
#: Chains for fitting are cut to this many tokens.
CHAIN = 64
STEPS, RATE, DECAY = 60, 0.4, 1e-3
SPAN = 0.5
THRESHOLD = 0.3


class Tokens:
    """Tokens of a batch of texts with their features."""

    def __init__(self, batch: pa.RecordBatch):
        self.data, self.offsets = text_bytes(batch.column("text"))
        self.start, self.end, self.row = word_bounds(self.data, self.offsets, NO_LETTER)
        hashes = Hasher(self.data)
        feeds = np.flatnonzero(self.data == 10)
        self.line = np.searchsorted(feeds, self.start) + self.row
        self.features = [hashes(self.start, self.end)]
        for length in PREFIXES:
            prefix = hashes(self.start, np.minimum(self.start + length, self.end))
            longer = self.end - self.start > length
            # A token that is not longer has no such prefix; its word stands in, to no effect.
            self.features.append(np.where(longer, mix(prefix + np.uint64(length)), self.features[0]))


@dataclass
class Field:
    """Weights of a fitted field and of the curve for documents."""

    keys: np.ndarray  # marking features in order
    weights: np.ndarray
    every: float = 0.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))  # log weights, from and to; [0, 0] is 0
    curve: tuple[float, float, float] | None = None

    def emissions(self, features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of each token by itself, and whether it has a marking feature."""
        total, marked = np.full(len(features[0]), self.every), np.zeros(len(features[0]), dtype=bool)
        seen: list[np.ndarray] = []
        for values in features:
            at = np.minimum(np.searchsorted(self.keys, values), max(len(self.keys) - 1, 0))
            hit = self.keys[at] == values if len(self.keys) else np.zeros(len(values), dtype=bool)
            for before in seen:
                hit &= values != before
            seen.append(values)
            total[hit] += self.weights[at[hit]]
            marked |= hit
        return total, marked


def _padded(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rows of one array as a matrix, filled up with 0."""
    place = np.arange(size.max())
    at = np.minimum(begin[:, None] + place, len(values) - 1)
    return np.where(place < size[:, None], values[at], 0.0)


def messages(emission: np.ndarray, size: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log odds of all chains, one a row; their sum is that of the marginal."""
    steps = np.exp(moves)
    forward, backward = emission.copy(), np.zeros_like(emission)
    width = emission.shape[1]
    for t in range(1, width):
        odds = np.exp(np.clip(forward[:, t - 1], -50, 50))
        forward[:, t] += np.log((steps[0, 1] + steps[1, 1] * odds) / (steps[0, 0] + steps[1, 0] * odds))
    for t in range(width - 2, -1, -1):
        odds = np.exp(np.clip(emission[:, t + 1] + backward[:, t + 1], -50, 50))
        message = np.log((steps[1, 0] + steps[1, 1] * odds) / (steps[0, 0] + steps[0, 1] * odds))
        backward[:, t] = np.where(t + 1 < size, message, 0.0)
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


@dataclass
class Chains:
    """Chains to learn from: their lengths and kinds, and where marking features (by number) stand in them."""

    size: np.ndarray
    toxic: np.ndarray
    chain: np.ndarray
    place: np.ndarray
    number: np.ndarray


def fit_field(keys: np.ndarray, chains: Chains) -> Field:
    """Fits the weights by gradient ascent (Adam) on labelled chains.

    The tokens with marking features are labelled 1 in toxic documents, all others 0.
    """
    size, chain, place, number = chains.size, chains.chain, chains.place, chains.number
    n, width = len(keys), int(size.max())
    inside = np.arange(width) < size[:, None]
    label = np.zeros((len(size), width), dtype=bool)
    marked = chains.toxic[chain]
    label[chain[marked], place[marked]] = True
    first, second, both = label[:, :-1], label[:, 1:], inside[:, 1:]
    moved = np.array([(x & both).sum() for x in (~first & second, first & ~second, first & second)], dtype=float)
    total = inside.sum()
    values = np.zeros(n + 4)  # the features, every token, moves 01, 10, 11
    values[n] = -3.0
    mean, square = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, STEPS + 1):
        moves = np.array([[0, values[-3]], [values[-2], values[-1]]])
        emission = np.where(inside, values[n], 0.0)
        np.add.at(emission, (chain, place), values[number])
        forward, backward = messages(emission, size, moves)
        wrong = (label - _sigmoid(forward + backward)) * inside
        slope = np.zeros_like(values)
        slope[:n] = np.bincount(number, weights=wrong[chain, place], minlength=n)
        slope[n] = wrong.sum()
        left = np.exp(np.clip(forward[:, :-1], -50, 50))
        right = np.exp(np.clip(emission[:, 1:] + backward[:, 1:], -50, 50))
        weight = [right * np.exp(moves[0, 1]), left * np.exp(moves[1, 0]), left * right * np.exp(moves[1, 1])]
        whole = 1 + weight[0] + weight[1] + weight[2]
        slope[-3:] = moved - [(w / whole * both).sum() for w in weight]
        slope = slope / total * 1000 - DECAY * values
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        values += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Field(keys, values[:n], float(values[n]), np.array([[0, values[-3]], [values[-2], values[-1]]]))


def marginals(tokens: Tokens, model: Field) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lines with marking features: the tokens' numbers and marginals; largest and sum of marginals by row."""
    rows = len(tokens.offsets) - 1
    largest, total = np.zeros(rows), np.zeros(rows)
    if not len(tokens.row):
        return np.zeros(0, np.int64), np.zeros(0), largest, total
    emission, marked = model.emissions(tokens.features)
    begin = np.flatnonzero(np.append(True, tokens.line[1:] != tokens.line[:-1]))
    size = np.diff(np.append(begin, len(tokens.line)))
    row = tokens.row[begin]
    hit = np.maximum.reduceat(marked, begin)

    plain_largest, plain_total = _plain(model, int(size[~hit].max(initial=1)))
    np.maximum.at(largest, row[~hit], plain_largest[size[~hit]])
    np.add.at(total, row[~hit], plain_total[size[~hit]])

    numbers, chances = [np.zeros(0, np.int64)], [np.zeros(0)]
    order = np.flatnonzero(hit)[np.argsort(size[hit], kind="stable")]
    while len(order):  # lines of similar length together
        n = max(1, int(np.searchsorted(size[order], 2 * size[order[0]] + 16)))
        some, order = order[:n], order[n:]
        forward, backward = messages(_padded(emission, begin[some], size[some]), size[some], model.moves)
        inside = np.arange(forward.shape[1]) < size[some][:, None]
        chance = np.where(inside, _sigmoid(forward + backward), 0.0)
        np.maximum.at(largest, row[some], chance.max(axis=1))
        np.add.at(total, row[some], chance.sum(axis=1))
        numbers.append((begin[some][:, None] + np.arange(forward.shape[1]))[inside])
        chances.append(chance[inside])
    return np.concatenate(numbers), np.concatenate(chances), largest, total


def _plain(model: Field, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest and sum of the marginals of lines without marking features, by length.

    In the middle of lines of over 256 tokens marginals don't change any more.
    """
    short = min(longest, 256)
    size = np.arange(1, short + 1)
    forward, backward = messages(np.where(np.arange(short) < size[:, None], model.every, 0.0), size, model.moves)
    chance = np.where(np.arange(short) < size[:, None], _sigmoid(forward + backward), 0.0)
    more = np.arange(1, longest - short + 1)
    largest = np.concatenate([[0.0], chance.max(axis=1), np.full(len(more), chance[-1].max())])
    return largest, np.concatenate([[0.0], chance.sum(axis=1), chance[-1].sum() + more * chance[-1, short // 2]])


def document_values(largest: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What the curve takes: a constant, log odds of the largest marginal, log of the sum."""
    odds = np.clip(largest, 1e-9, 1 - 1e-9)
    return np.stack([np.ones_like(largest), np.log(odds / (1 - odds)), np.log(total + 1e-6)], axis=1)


def fit_curve(values: np.ndarray, toxic: np.ndarray, share: float) -> tuple[float, float, float]:
    """Logistic weights by Newton's method, for documents of which ``share`` are toxic."""
    middle, spread = values.mean(axis=0), values.std(axis=0) + 1e-9
    middle[0], spread[0] = 0.0, 1.0
    scaled, weights = (values - middle) / spread, np.zeros(3)
    importance = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    for _ in range(30):
        chance = _sigmoid(scaled @ weights)
        slope = scaled.T @ (importance * (toxic - chance)) - 0.1 * weights
        bend = (scaled * (importance * chance * (1 - chance))[:, None]).T @ scaled + 0.1 * np.eye(3)
        weights = weights + np.linalg.solve(bend, slope)
    weights = weights / spread
    weights[0] -= (weights[1:] * middle[1:]).sum()
    return tuple(weights)


def _sample(docs: DataFrame, labels: DataFrame, label_col: str) -> tuple[DataFrame, float]:
    """Stored rows (text, toxic) to learn from, and the share of toxic labels."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max(label_col) == 1).alias("toxic"))
    n, toxic = known.agg(F.count("*"), F.sum(F.col("toxic").cast("long"))).first()
    drawn = known.orderBy(F.xxhash64("doc_id"))
    some = stored(drawn.filter("toxic").limit(LABELLED).unionByName(drawn.filter("NOT toxic").limit(LABELLED)), "labelled")
    # At most 2 * LABELLED ids.
    return stored(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "toxic"), "sample"), (toxic or 0) / max(n, 1)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> Field | None:
    """The fitted model, or None without labels of both kinds. ``docs`` has doc_id and text, ``labels`` doc_id."""
    sample, share = _sample(docs, labels, label_col)
    kinds = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(kinds) < 2:
        return None

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (feature, toxic), one for every document and feature."""
        for batch in slices(batches, "text"):
            tokens = Tokens(batch)
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            feature, row = np.concatenate(tokens.features), np.tile(tokens.row, len(tokens.features))
            order = np.lexsort((feature, row))
            feature, row = feature[order], row[order]
            first = np.append(True, (feature[1:] != feature[:-1]) | (row[1:] != row[:-1]))[: len(row)]
            columns = [pa.array(feature[first].view(np.int64)), pa.array(toxic[row[first]])]
            yield pa.RecordBatch.from_arrays(columns, names=["feature", "toxic"])

    in_docs = sample.mapInArrow(count, "feature long, toxic boolean").groupBy("feature")
    counts = in_docs.agg(F.sum(F.col("toxic").cast("long")).alias("toxic"), F.count("*").alias("n"))
    times = ((F.col("toxic") + 0.5) / (kinds[True] + 1)) / ((F.col("n") - F.col("toxic") + 0.5) / (kinds[False] + 1))
    marking = counts.filter((times >= RATIO) & (F.col("toxic") * F.log(times) >= EVIDENCE)).select("feature").toArrow()
    keys = np.sort(marking.column("feature").to_numpy().view(np.uint64))
    if not len(keys):
        return None

    def chains(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (size, toxic, places, numbers): lines with marking features, and the first lines of other documents."""
        for batch in slices(batches, "text"):
            tokens = Tokens(batch)
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            begin = np.flatnonzero(np.append(True, tokens.line[1:] != tokens.line[:-1]))[: len(tokens.line)]
            _, marked = Field(keys, np.zeros(len(keys))).emissions(tokens.features)
            rows = []
            for first, after in zip(begin.tolist(), [*begin[1:].tolist(), len(marked)], strict=True):
                row = tokens.row[first]
                plain = not marked[first:after].any()
                if plain and (toxic[row] or (first and tokens.row[first - 1] == row)):
                    continue
                for at in range(first, after, CHAIN):
                    end = min(at + CHAIN, after)
                    pairs = set()
                    for values in tokens.features:
                        found = np.minimum(np.searchsorted(keys, values[at:end]), len(keys) - 1)
                        hit = np.flatnonzero(keys[found] == values[at:end])
                        pairs |= {*zip(hit.tolist(), found[hit].tolist(), strict=True)}
                    places, numbers = ([p[k] for p in sorted(pairs)] for k in (0, 1))
                    rows.append({"size": end - at, "toxic": bool(toxic[row]), "places": places, "numbers": numbers})
            yield pa.RecordBatch.from_pylist(rows, schema=chain_schema)

    lists = pa.list_(pa.int64())
    chain_schema = pa.schema([("size", pa.int64()), ("toxic", pa.bool_()), ("places", lists), ("numbers", lists)])
    found = sample.mapInArrow(chains, "size long, toxic boolean, places array<long>, numbers array<long>").toArrow().combine_chunks()
    counts = pa.compute.list_value_length(found.column("places")).to_numpy()
    place, number = (pa.compute.list_flatten(found.column(c)).to_numpy() for c in ("places", "numbers"))
    size, toxic = found.column("size").to_numpy(), found.column("toxic").to_numpy()
    model = fit_field(keys, Chains(size, toxic.astype(bool), np.repeat(np.arange(len(size)), counts), place, number))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            _, _, largest, total = marginals(Tokens(batch), model)
            yield pa.RecordBatch.from_arrays([pa.array(largest), pa.array(total), batch.column("toxic")], names=["largest", "total", "toxic"])

    seen = sample.mapInArrow(measure, "largest double, total double, toxic boolean").toPandas()
    values = document_values(seen["largest"].to_numpy(), seen["total"].to_numpy())
    model.curve = fit_curve(values, seen["toxic"].to_numpy(bool), share)
    return model


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", label_id: str = "doc_id"
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, and the toxic spans as offsets in code points."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = fit(texts, labels.select(F.col(label_id).alias("doc_id"), label_col), label_col)
    made = T.StructType.fromDDL("score double, spans array<struct<start:long,stop:long>>")
    schema = T.StructType([texts.schema["doc_id"], T.StructField("held_out", T.BooleanType()), *made.fields])
    arrow = arrow_schema(schema)
    span_type = arrow.field("spans").type

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            scores, spans = np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
            if model is not None:
                tokens = Tokens(batch)
                numbers, chances, largest, total = marginals(tokens, model)
                scores = _sigmoid(document_values(largest, total) @ np.array(model.curve))
                toxic = np.sort(numbers[chances >= SPAN])
                chars = char_positions(tokens.data, tokens.offsets) if len(toxic) else None
                for i in toxic.tolist():
                    row = tokens.row[i]
                    base = chars[tokens.offsets[row]]
                    start, stop = int(chars[tokens.start[i]] - base), int(chars[tokens.end[i]] - base)
                    if spans[row] and i and spans[row][-1][2] == i - 1 and tokens.line[i] == tokens.line[i - 1]:
                        start = spans[row].pop()[0]  # neighbours are one span
                    spans[row].append((start, stop, i))
            listed = pa.array([[{"start": a, "stop": b} for a, b, _ in row] for row in spans], span_type)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores), listed], schema=arrow)

    scored = texts.withColumn("held_out", held_out(F.col("doc_id"))).select("doc_id", "held_out", "text").mapInArrow(work, schema)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "spans")
