"""Toxicity through a noisy channel: disguised words are restored by a Viterbi decoder before they are scored.

A character trigram model is counted over all documents. Words that show signs of disguise (digits or signs next to letters, letters
repeated, single letters in a row) span a lattice: every character may stand for itself or for the letters it imitates, and every run
of one letter for one or two of it. In a run of short fragments (``y o u s t u p i d``) every gap is an edge too, which is dropped or
kept as the edge of a word. The cheapest path under the model is the restored word. Where the word without its outer signs is
made of letters alone, as in ``tax!`` or ``letter``, it counts beside the restored one. Clean words have a lattice of one path and are
scored as they are. Weights of words and of word beginnings are learned from labelled documents.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from querylode import lineage
from querylode.llm import common, encoding, worker

#: Labelled documents the weights are fitted on, at most.
FIT_ROWS = 20_000
#: Features kept, at most: those of the surest evidence.
FEATURES = 20_000
#: Features that chance may try.
TRIED = 1_000_000
#: Classes of the model: 0 the edge of a word, 1 anything else, then a-z, then U+00DF to U+00FF.
CLASSES = 64
#: What a character may stand for besides itself.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
#: Cost of reading a character as another, of reading a run of a letter as two, and of dropping a separator.
SWAP_COST, DOUBLE_COST, DROP_COST = 1.0, 0.5, 1.0
#: So many of one sign at the edge of a word decorate it; they may be letters only where the model finds that cheaper.
DECORATION = 3
#: Logit of a text without any word of evidence.
LEAST = -4.0
_EDGES = ".,;:!?\"'`()[]{}<>#%&*|$~^=+-_/\\…«»“”‘’¿¡"
#: Those that imitate no letter.
_OUTER = "".join(c for c in _EDGES if c not in LEET)
_CLEAN = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1+")
_RUNS = re.compile(r"(.)\1*", re.DOTALL)
#: Three tokens in a row or more of one or two runs of a character each.
_PIECE = r"(\S)\{0}*+(?:(\S)\{1}*+)?+"
_SPACED = re.compile(rf"(?<!\S){_PIECE.format(1, 2)}(?:\s++{_PIECE.format(3, 4)}(?!\S)){{2,}}+")
_TOKEN = re.compile(r"(\s*)(\S+)")


def _classes() -> np.ndarray:
    """Class of every code point below 0x180; those above share the last entry."""
    table = np.ones(0x181, np.int64)
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = 2 + i
    for c in range(0xDF, 0x100):
        table[c] = 28 + c - 0xDF
        if c - 32 >= 0xC0:
            table[c - 32] = table[c]
    table[[9, 10, 11, 12, 13, 32]] = 0
    return table


TABLE = _classes()
_TABLE = TABLE.tolist()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES**3, np.int64)
    for batch in batches:
        for _, texts in encoding.slices(batch.column("text")):
            codes = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
            cls = TABLE[np.minimum(codes, 0x180)]
            total += np.bincount((cls[:-2] * CLASSES + cls[1:-1]) * CLASSES + cls[2:], minlength=CLASSES**3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """Costs (negative log likelihoods) of a character class after two others, counted over all texts of ``docs``.

    At most ``CLASSES`` ** 3 counts reach the driver, whatever the size of the corpus.
    """
    grams = docs.select(common.text_of().alias("text")).mapInArrow(_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(CLASSES**3)
    for row in grams.collect():
        counts[row["gram"]] = row["n"]
    three = counts.reshape(CLASSES, CLASSES, CLASSES)
    two = three.sum(axis=0)
    one = two.sum(axis=0) + 1.0
    one /= one.sum()
    pair = (two + 20 * one[None, :]) / (two.sum(axis=1, keepdims=True) + 20)
    return -np.log((three + 20 * pair[None]) / (three.sum(axis=2, keepdims=True) + 20))


@lru_cache(100_000)
def _ways(char: str, many: int) -> tuple[tuple[str, tuple[int, ...], float], ...]:
    """The strings that ``many`` (3 stands for more) of one character may stand for, with their classes and costs."""
    letters = [(char, 0.0)] if char.isalpha() else [(c, SWAP_COST) for c in LEET.get(char, "")]
    ways = [(c, cost) for c, cost in letters] + [(c + c, cost + (DOUBLE_COST if many > 2 else 0.0)) for c, cost in letters if many > 1]
    if many == 2 and char.isalpha():
        ways = [(char * 2, 0.0), (char, DOUBLE_COST)]
    if not char.isalpha():
        ways.append(("", DROP_COST if not letters else SWAP_COST + DROP_COST))
    return tuple((string, tuple(_TABLE[min(ord(c), 0x180)] for c in string), cost) for string, cost in ways)


def _readings(word: str) -> list[tuple]:
    """The lattice: per run of one character the strings it may stand for, with their classes and costs."""
    return [_ways(run[1], min(3, len(run[0]))) for run in _RUNS.finditer(word)]


def _cheapest(lattice: list[tuple], model) -> str:
    """The cheapest path; the state is the last two classes. Paths share their beginnings, so time and memory grow with the length."""
    paths = {(0, 0): (0.0, None)}
    for ways in lattice:
        after: dict[tuple[int, int], tuple] = {}
        for (a, b), (cost, text) in paths.items():
            for string, classes, extra in ways:
                x, y, total = a, b, cost + extra
                for z in classes:
                    total += model[x][y][z]
                    x, y = y, z
                if (x, y) not in after or total < after[x, y][0]:
                    after[x, y] = (total, (text, string))
        paths = after
    at, out = min(((cost + model[x][y][0], n, text) for n, ((x, y), (cost, text)) in enumerate(paths.items())), key=lambda p: p[:2])[2], []
    while at:
        at, string = at
        out.append(string)
    return "".join(reversed(out))


def restore(word: str, model) -> str:
    """The cheapest path through the lattice of ``word``; ``model`` is an array or the same as nested lists, which are faster."""
    return _cheapest(_readings(word), model)


def _gapped(run: str, drop: float) -> list[tuple]:
    """The lattice of a run of fragments; ``drop`` is the cost of dropping a gap between single characters."""
    tokens = [(gap, [(r[1], min(3, len(r[0]))) for r in _RUNS.finditer(token)]) for gap, token in _TOKEN.findall(run)]
    narrow = min(len(gap) for gap, _ in tokens[1:])
    lattice: list[tuple] = []
    last, many, single = "", 0, False
    for gap, runs in tokens:
        (char, count), alone = runs[0], len(runs) == 1
        if lattice and single and alone and char == last and len(gap) == narrow:
            many = min(3, many + count)
            parted = tuple((f"{w} {w}", (*k, 0, *k), cost) for w, k, cost in _ways(char, 1) if w)
            lattice[-1] = _ways(char, many) + parted
            continue
        if lattice:
            lattice.append(((" ", (0,), 0.0), ("", (), (0.0 if single and alone else DROP_COST) + (DROP_COST if len(gap) > narrow else 0.0))))
        lattice += [_ways(c, n) for c, n in runs]
        last, many, single = char, count, alone
    return lattice


def spelled(run: str, model) -> set[str]:
    """The words that a run of short fragments spells: each gap is dropped or parts words, whichever makes the cheaper path.

    Between single characters the gaps say nothing, so that dropping one may be free unless it is wider than others of the run; the
    words of the paths with and without that cost are both given. A character repeated over gaps is a run of it, or ends one word and
    begins the next.
    """
    if not any(c.isalpha() for c in run):
        return set()
    return {w for cost in (0.0, DROP_COST) for w in _cheapest(_gapped(run, cost), model).split() if len(w) > 1}


def _class(char: str) -> int:
    return _TABLE[min(ord(char), 0x180)] if char else 0


class Reader:
    """Words of a text as they are meant: cleaned, restored where disguised. It remembers what it has read: words of the last
    ``bound`` / 2 to ``bound`` distinct ones, and those among older ones that came up again."""

    def __init__(self, model: np.ndarray, bound: int = 100_000) -> None:
        self.model, self.bound, self.known, self.older = model.tolist(), bound, {}, {}

    def _doubled(self, word: str, runs: list[re.Match]) -> str | None:
        """The cheapest path through a word of letters with a few letters twice, each run by itself: once the next single letter is read,
        both paths are in the same state. None if runs touch or are longer."""
        out, at = [], 0
        for run, after in zip(runs, [*runs[1:], None]):
            start, stop = run.span()
            if stop - start != 2 or after and after.start() == stop:
                return None
            b, c, d = _class(word[start - 1 : start] if start else ""), _class(word[start]), _class(word[stop : stop + 1])
            twice = self.model[b][c][c] + self.model[c][c][d] <= DOUBLE_COST + self.model[b][c][d]
            out.append(word[at : stop if twice else start + 1])
            at = stop
        return "".join(out) + word[at:]

    def word(self, raw: str) -> str | None:
        """The cheapest reading of ``raw``; signs at its edges that imitate letters may be letters as well."""
        whole = raw.strip(_OUTER)
        if whole.isalpha():
            runs = list(_RUN.finditer(whole))
            return whole if not runs else self._doubled(whole, runs) or restore(whole, self.model)
        if _CLEAN.fullmatch(whole) and not _RUN.search(whole):
            return whole
        if not any(c.isalpha() for c in whole):
            return None
        return restore(whole, self.model) or raw.strip(_EDGES)

    def read(self, raw: str) -> tuple[str, ...]:
        """What ``raw`` may mean: its cheapest reading, and with signs at its edges those in which all of them are letters or none is."""
        if raw.isalpha() and not _RUN.search(raw):
            return (raw,)
        meant, plain, whole = self.word(raw), raw.strip(_EDGES), raw.strip(_OUTER)
        found = [meant, plain if _CLEAN.fullmatch(plain) else None]
        if plain and whole != plain and meant:
            lattice, runs = _readings(whole), [m[0] for m in _RUNS.finditer(whole)]
            for at in (0, -1):
                if len(runs[at]) < DECORATION:
                    lattice[at] = tuple(w for w in lattice[at] if w[0]) or lattice[at]
            found.append(_cheapest(lattice, self.model))
        return tuple(dict.fromkeys(w for w in found if w))

    def words(self, text: str) -> set[str]:
        """Distinct restored words; short fragments in a row also give the words they spell."""
        lower = text.lower()
        if 2 * len(self.known) > self.bound:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        found: set[str] = set()
        for raw in set(lower.split()):
            meant = known.get(raw)
            if meant is None:
                meant = known[raw] = older.get(raw) or self.read(raw)
            found.update(meant)
        for run in _SPACED.finditer(lower):
            found.update(spelled(run[0], self.model))
        return found


def reader_of(model: np.ndarray) -> Reader:
    """One reader per worker and model: what one task has read serves the next ones and the other passes."""
    return worker.resident(("reader", hashlib.blake2b(model.tobytes(), digest_size=16).digest()), lambda: Reader(model))


def features(word: str) -> tuple[str, ...]:
    """The word, and its beginnings of four to seven letters, which inflected words share."""
    return (f"={word}",) + tuple(f"^{word[:n]}" for n in (4, 5, 6, 7) if len(word) >= n)


def _evidence(model: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, seen = reader_of(model), {0: Counter(), 1: Counter()}
        for batch in batches:
            labels = batch.column("toxic").to_pylist()
            for first, texts in encoding.slices(batch.column("text")):
                for text, label in zip(texts, labels[first : first + len(texts)]):
                    seen[label].update({f for w in reader.words(text) for f in features(w)})
        for label, counter in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counter), pa.string()), pa.array([label] * len(counter), pa.int32()),
                 pa.array(list(counter.values()), pa.int64())], names=["feature", "label", "n"])

    return count


def evidence(labelled: DataFrame, model: np.ndarray) -> dict[str, tuple[int, int]]:
    """Feature -> (documents of label 1 with it, documents with it) over ``labelled`` (text, toxic 0/1); "" has those of all.

    Kept are features that gain more over the base rate (likelihood ratio) than chance would among ``TRIED``, at most ``FEATURES``.
    """
    sizes = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bads, total = sizes.get(1, 0), sizes.get(0, 0) + sizes.get(1, 0)
    base = (bads + 0.5) / (total + 1)
    counted = labelled.mapInArrow(_evidence(model), "feature string, label int, n long").groupBy("feature").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum("n").alias("n"))
    bad, n = F.col("bad"), F.col("n")
    gain = 2 * (bad * F.log(bad / n / base) + F.when(n > bad, (n - bad) * F.log((n - bad) / n / (1 - base))).otherwise(0))
    sure = counted.where("bad > 0").where((bad / n > base) & (3 * bad > n)).withColumn("gain", gain).where(F.col("gain") > 2 * math.log(TRIED))
    kept = sure.orderBy(F.desc("gain"), "feature").limit(FEATURES).collect()
    return {"": (bads, total), **{r["feature"]: (r["bad"], r["n"]) for r in kept}}


def _sureness(bad: int, n: int, z: float = 1.64) -> float:
    """Logit of the lower end of Wilson's interval of bad / n."""
    if n < 1 or bad < 1:
        return LEAST
    share = bad / n
    low = (share + z * z / (2 * n) - z * math.sqrt((share * (1 - share) + z * z / (4 * n)) / n)) / (1 + z * z / n)
    return max(LEAST, math.log(low / (1 - low)))


def _summary(words: set[str], known: dict[str, tuple[int, int]], values: dict[str, tuple], label: int | None = None) -> tuple:
    """What the score sees of a text: the two surest words, how many are sure, and how many there are. With ``label`` the document's
    own part in the evidence is taken out."""
    first, second, many = LEAST, LEAST, 0
    for w in words:
        found = values.get(w)
        if found is None:
            found = values[w] = tuple(known[f] for f in features(w) if f in known)
        if not found:
            continue
        own = 0 if label is None else 1
        value = max(_sureness(bad - (label or 0), n - own) for bad, n in found)
        many += value > 0
        if value > first:
            first, second = value, first
        elif value > second:
            second = value
    return first, second, math.log1p(many), math.log1p(len(words))


def _training(model: np.ndarray, known: dict[str, tuple[int, int]]):
    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, values = reader_of(model), {}
        for batch in batches:
            labels, out = batch.column("toxic").to_pylist(), []
            for first, texts in encoding.slices(batch.column("text")):
                out += [(*_summary(reader.words(t), known, values, y), float(y)) for t, y in zip(texts, labels[first : first + len(texts)])]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in zip(*out)], names=["a", "b", "c", "d", "y"])

    return summaries


def fit(labelled: DataFrame, model: np.ndarray, known: dict[str, tuple[int, int]]) -> np.ndarray:
    """Coefficients of a logistic regression over the summaries of ``labelled``; its rows are bounded by the caller."""
    rows = labelled.mapInArrow(_training(model, known), "a double, b double, c double, d double, y double").collect()
    if not rows:
        return np.array([-9.0, 0, 0, 0, 0])
    data = np.array(sorted(tuple(r) for r in rows))
    x, y = np.column_stack([np.ones(len(data)), data[:, :4]]), data[:, 4]
    beta, ridge = np.zeros(5), np.diag([1e-3, 0.1, 0.1, 0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (y - p) - ridge @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta


class Scorer:
    """Scores of texts; one per task, since it remembers words."""

    def __init__(self, model: np.ndarray, known: dict[str, tuple[int, int]], beta: np.ndarray) -> None:
        self.reader, self.beta, self.values = reader_of(model), beta, {}
        self.known = {f: c for f, c in known.items() if f}

    def scores(self, column: pa.Array) -> np.ndarray:
        rows: list[tuple] = []
        for _, texts in encoding.slices(column):
            if len(self.values) > self.reader.bound:
                self.values.clear()
            rows += [_summary(self.reader.words(t), self.known, self.values) for t in texts]
        x = np.column_stack([np.ones(len(rows)), np.array(rows)]) if rows else np.zeros((0, 5))
        return 1 / (1 + np.exp(-np.clip(x @ self.beta, -30, 30)))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS):
    """What a ``Scorer`` is made of: the character model of ``docs``, the evidence and the coefficients; see ``score``."""
    texts = docs.select("doc_id", common.text_of().alias("text"))
    model = language_model(docs)
    usable = labels.select("doc_id", "toxic").where(F.col("doc_id").isNotNull() & ~held_out() & F.col("toxic").isin(0, 1)).dropDuplicates(["doc_id"])
    chosen = lineage.stored(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "toxic-sample")
    taught = texts.join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))  # fit_rows bounds it
    taught = lineage.stored(taught, "toxic-texts")
    known = evidence(taught, model)
    beta = fit(taught, model, known)
    return model, known, beta


def score(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic 0/1; other values and null are ignored) teaches the weights, from at most ``fit_rows`` rows that are not
    held out. Null and empty texts have no words and get the score of such texts. Without labels no text is toxic. Repeated rows are scored
    alike; other columns are ignored.
    """
    texts = docs.select("doc_id", common.text_of().alias("text"))
    kind, parts = docs.schema["doc_id"].dataType.simpleString(), fitted(docs, labels, fit_rows)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*parts)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scorer.scores(batch.column("text")))], names=["doc_id", "score"])

    scored = texts.mapInArrow(judge, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns stay. Rows are judged one by one where they stand."""
    with lineage.scratch(docs.sparkSession):
        parts = fitted(docs, labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*parts)
        for batch in batches:
            yield batch.filter(pa.array(scorer.scores(batch.column("text")) < threshold))

    return docs.mapInArrow(keep, docs.schema)
