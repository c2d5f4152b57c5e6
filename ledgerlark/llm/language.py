"""Language of texts by a mixture over n-gram models (operator 10).

Training counts hashed character trigrams per language over all learnable documents; what tasks count is summed in
ranges of buckets into a written table. Prediction takes a text as a mixture of languages: expectation-maximisation estimates the
shares of a set of languages from the n-gram likelihoods, until a round gains less than ``TOLERANCE``. The set maximises the likelihood less a penalty
for each language that grows with the logarithm of the text's length: languages join it, steepest first, and leave it again, as long as that gains.
The likelihood is concave in the shares, so a language whose slope promises less than the penalty is never tried.

A task holds the models of ``MAX_LANGUAGES`` languages at once. More languages go through in blocks, each of which is offered
to the set that a text has chosen so far (carried as its likelihoods); every language is offered once.

Defined cases. Null texts and texts without letters are ``und`` with score 0. Rows without language or id teach
nothing; a row without id is not held out. Equal shares go to the language first in alphabetical order. Without any
learnable row all texts are ``und``. Repeated rows count as often as they stand there. Very long texts are read whole. Result
columns replace columns of their names; helper columns take names that are free.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.session import materialise

from .batches import fresh, record, slices

BUCKETS = 1 << 15
RANGE = 512                # buckets in one row of counts
SMOOTHING = 0.5
ROUNDS = 500               # at most; the tolerance ends nearly all texts long before
TOLERANCE = 1e-3           # gain in log-likelihood of a round that ends the estimation
PENALTY = 6.0              # log-likelihood a further language must gain, times half the log of the text's trigrams
MAX_LANGUAGES = 500        # languages in one block of the model: x buckets x 4 bytes, 64 MB in a task at most
UNDETERMINED = "und"


def trigrams(text: str) -> np.ndarray:
    """Buckets of the trigrams of lower-cased letters; ASCII characters that are no letters count as spaces."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = np.where((points < 128) & ((points < 97) | (points > 122)), np.uint32(32), points)
    points = np.concatenate(([np.uint32(32)], points, [np.uint32(32)]))
    a, b, c = points[:-2], points[1:-1], points[2:]
    hashed = (a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA77)) * np.uint32(0xC2B2AE3D) + c * np.uint32(0x27D4EB2F)
    hashed ^= hashed >> np.uint32(15)
    return (hashed[b != 32] & np.uint32(BUCKETS - 1)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def count_trigrams(rows: DataFrame) -> DataFrame:
    """(lang, part, counts): counts of a range of buckets as little-endian 64-bit integers, from rows (lang, text)."""
    schema = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("counts", pa.binary())])

    def emit(found: dict[str, np.ndarray]):
        rows = [(lang, part, c.astype("<i8").tobytes()) for lang, counts in found.items()
                for part, c in enumerate(counts.reshape(-1, RANGE)) if c.any()]
        if rows:
            yield record(schema, *map(list, zip(*rows)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    if lang not in found:
                        if len(found) >= MAX_LANGUAGES:      # labels without end are passed on, not held
                            yield from emit(found)
                            found = {}
                        found[lang] = np.zeros(BUCKETS, dtype=np.int64)
                    found[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
        yield from emit(found)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            out = []
            for lang, part, raw in zip(*(batch.column(c).to_pylist() for c in ("lang", "part", "counts"))):
                counts = np.frombuffer(raw, dtype="<i8")
                if now == (lang, part):
                    total = total + counts
                else:
                    if now:
                        out.append((*now, total.tobytes()))
                    now, total = (lang, part), counts
            if out:
                yield record(schema, *map(list, zip(*out)))
        if now:
            yield record(schema, [now[0]], [now[1]], [total.tobytes()])

    counted = rows.mapInArrow(count, "lang string, part int, counts binary")
    return counted.repartition("lang", "part").sortWithinPartitions("lang", "part").mapInArrow(
        add, "lang string, part int, counts binary")


def estimate(likely: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the languages (columns of ``likely``) in trigrams met ``counts`` times, and the log-likelihood."""
    shares, fit = np.full(likely.shape[1], 1 / likely.shape[1]), -np.inf
    for _ in range(ROUNDS if len(shares) > 1 else 1):
        joint = likely * shares
        whole = joint.sum(axis=1)
        now = float(counts @ np.log(whole))
        if now - fit < TOLERANCE or len(shares) == 1:
            return shares, now
        shares, fit = (counts / whole) @ joint / counts.sum(), now
    return shares, float(counts @ np.log(likely @ shares))


def select(likely: np.ndarray, counts: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The chosen languages (columns of ``likely``) and their shares."""
    total = counts.sum()
    cost = PENALTY * 0.5 * np.log(total + 1)
    chosen = [int(np.argmax(counts @ np.log(likely)))]
    shares, fit = estimate(likely[:, chosen], counts)
    while True:
        # No set that has one more language can gain more than its slope at the present mixture beyond the total.
        slope = (counts / (likely[:, chosen] @ shares)) @ likely - total
        slope[chosen] = -np.inf
        for candidate in np.argsort(-slope, kind="stable").tolist():
            if slope[candidate] <= cost:
                return chosen, shares
            wider, better = estimate(likely[:, [*chosen, candidate]], counts)
            if better - fit > cost:
                break
        else:
            return chosen, shares
        chosen, shares, fit = [*chosen, candidate], wider, better
        while len(chosen) > 1:
            without = [chosen[:n] + chosen[n + 1:] for n in range(len(chosen))]
            left = [estimate(likely[:, c], counts) for c in without]
            best = max(range(len(left)), key=lambda n: left[n][1])
            if fit - left[best][1] >= cost:
                break
            chosen, (shares, fit) = without[best], left[best]


class Mixture:
    """Likelihoods of trigrams for a block of languages."""

    def __init__(self, languages: list[str], likely: np.ndarray):
        self.languages, self.likely = languages, likely

    @classmethod
    def of_counts(cls, counts: dict[str, np.ndarray]) -> Mixture:
        languages = sorted(counts)
        likely = np.empty((BUCKETS, len(languages)), dtype=np.float32)
        for n, lang in enumerate(languages):
            smooth = counts[lang] + SMOOTHING
            likely[:, n] = smooth / smooth.sum()
        return cls(languages, likely)

    def offer(self, text: str | None, names: list[str] = (), carried: bytes = b"") -> tuple[list[str], bytes, np.ndarray]:
        """Names, likelihoods and shares of the set chosen from this block and what is ``carried`` from earlier ones."""
        buckets, counts = np.unique(trigrams(text), return_counts=True) if has_letter(text) else (np.zeros(0), np.zeros(0))
        if not len(buckets) or not (self.languages or names):
            return [], b"", np.zeros(0)
        before = np.frombuffer(carried, dtype=np.float32).reshape(len(buckets), len(names))
        pool = np.concatenate([before, self.likely[buckets]], axis=1)
        chosen, shares = select(pool.astype(np.float64), counts)
        known = [*names, *self.languages]
        return [known[n] for n in chosen], pool[:, chosen].tobytes(), shares


class Model:
    """The counts of a written table as mixtures of at most ``size`` languages each."""

    def __init__(self, counts: DataFrame, size: int):
        self.counts, self.size = counts, size
        self.n_languages = counts.select("lang").distinct().count()
        self.n_blocks = max(1, -(-self.n_languages // size))

    def blocks(self) -> Iterator[Mixture]:
        names, last = self.counts.select("lang").distinct(), None
        for _ in range(self.n_blocks):
            rest = names if last is None else names.filter(F.col("lang") > last)
            block = [r["lang"] for r in rest.orderBy("lang").limit(self.size).collect()]
            counts = {lang: np.zeros(BUCKETS, dtype=np.int64) for lang in block}
            if block:
                last = block[-1]
                for row in self.counts.filter(F.col("lang").between(block[0], last)).toLocalIterator():
                    counts[row["lang"]][row["part"] * RANGE:(row["part"] + 1) * RANGE] = np.frombuffer(row["counts"], "<i8")
            yield Mixture.of_counts(counts)

    def shares(self, text: str | None) -> dict[str, float]:
        """Languages of the selected set with their shares; nothing where there is nothing to tell by."""
        names, carried, shares = [], b"", np.zeros(0)
        for block in self.blocks():
            names, carried, shares = block.offer(text, names, carried)
        return dict(zip(names, shares.tolist()))


def learn(rows: DataFrame, size: int = MAX_LANGUAGES) -> Model:
    """A model from all rows (lang, text) with both; ``size`` languages are held at once."""
    return Model(materialise(count_trigrams(rows.filter("lang IS NOT NULL AND length(text) > 0")), "trigram-counts"), size)


def _told(df: DataFrame, source: str, held: str, model: Mixture, last: bool, names: list[str]) -> DataFrame:
    """Offer a block to each row: what it carries on in ``held``, or after the last block the results ``names``."""
    more = held in df.columns
    kept = [f for f in df.schema if f.name != held and not (last and f.name == source)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    types = ["string", "double", "map<string,double>"][:len(names)]
    schema += "".join(f", `{n}` {t}" for n, t in zip(names, types)) if last else f", `{held}` struct<names:array<string>,likely:binary>"
    languages, likely = model.languages, model.likely
    held_type = pa.struct([("names", pa.list_(pa.string())), ("likely", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Mixture(languages, likely)
        for batch in batches:
            for part in slices(batch, source):
                before = part.column(held).to_pylist() if more else [{"names": [], "likely": b""}] * part.num_rows
                found = [own.offer(t, b["names"], b["likely"]) for t, b in zip(part.column(source).to_pylist(), before)]
                rest = part.select([f.name for f in kept])
                if last:
                    shares = [dict(zip(n, s.tolist())) for n, _, s in found]
                    best = [max(sorted(f), key=f.get) if f else UNDETERMINED for f in shares]
                    columns = [pa.array(best, pa.string()), pa.array([min(1.0, f.get(b, 0.0)) for f, b in zip(shares, best)], pa.float64()),
                               pa.array([list(f.items()) for f in shares], pa.map_(pa.string(), pa.float64()))][:len(names)]
                else:
                    columns = [pa.array([{"names": n, "likely": c} for n, c, _ in found], held_type)]
                yield pa.RecordBatch.from_arrays([*rest.columns, *columns], schema=pa.schema(
                    [*rest.schema, *(pa.field(n, c.type) for n, c in zip(names if last else [held], columns))]))

    return df.mapInArrow(work, schema)


def predict(df: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score",
            shares: str | None = "lang_shares") -> DataFrame:
    """Add the main language, its share and the shares of all languages of the text; columns of these names are replaced."""
    names = [lang, score] + ([shares] if shares else [])
    rest = df.drop(*[n for n in names if n != text])
    source, held = fresh(rest, "language_text", "language_set")
    rows = rest.withColumn(source, F.col(text))
    rows = rows.drop(text) if text in names else rows
    for n, block in enumerate(model.blocks(), 1):
        rows = _told(rows, source, held, block, n == model.n_blocks, names)
        if n < model.n_blocks:
            rows = materialise(rows, "language-sets")
    return rows


def held_out(doc_id: Column) -> Column:
    """Documents that teach nothing: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def language_rows(df: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    own = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    model = learn(df.filter(own != 2).select("lang", "text"))
    told = predict(df.select("doc_id", "text"), model, shares=None)
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
