"""Language identification by interpolated Kneser-Ney character models.

Texts are folded to lower-case letters with single spaces between runs of them. For each language
an interpolated Kneser-Ney model of ``ORDER`` characters gives log probabilities; all languages
share one sorted array of n-gram hashes per order, with a column of log probabilities for each
language, and one sorted array of context hashes with back-off weights. A text's cross-entropy
under a language is the mean over its characters; the least wins. A text is rejected when even the
least lies beyond what that language's own held-back texts showed at its length.

Counting is a Spark aggregation over at most ``max_rows`` training texts of each language (those
with the least hash of their id); the model's size is bounded by them. Prediction reads whole texts.

Null texts and texts without a letter are ``und``, score 0, rejected. Rows with a null language are
not learned from; without any training row every text is ``und``. Ties go to the language that
sorts first. Repeated rows and other columns do not matter.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.llm.common import MIX, chunked, mixed, narrowed

ORDER = 4
#: Training texts of each language, and characters that one chunk of work holds (or one text).
MAX_ROWS, CHUNK = 1_500, 250_000
SPACE = 32
UNDETERMINED = "und"
PREDICTION = "lang_pred string, score double, cross_entropy double, rejected boolean"


@cache
def folding() -> np.ndarray:
    """For each code point the letter it counts as, or a space."""
    table = np.full(0x110000, SPACE, np.uint32)
    for code in range(0x110000):
        if (letter := chr(code)).isalpha() or unicodedata.category(letter)[0] == "M":
            table[code] = ord(letter.lower()[0])
    return table


@cache
def letters() -> np.ndarray:
    """Which code points are letters; marks count as letters only beside one."""
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), bool, 0x110000)


def folded(text: str | None) -> np.ndarray:
    """Letters in lower case, with one space between runs and at both ends; empty without a letter."""
    if not text:
        return np.empty(0, np.uint32)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    if not letters()[points].any():
        return np.empty(0, np.uint32)
    codes = folding()[points]
    codes = np.concatenate(([SPACE], codes, [SPACE])).astype(np.uint32)
    space = codes == SPACE
    codes = codes[~(space & np.concatenate(([False], space[:-1])))]
    return codes if len(codes) > 1 else np.empty(0, np.uint32)


def keys(codes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` characters that end at each position from ``width`` - 1 on."""
    count = max(0, len(codes) - width + 1)
    total = np.full(count, np.uint64(width), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            total = (total + codes[k : k + count].astype(np.uint64)) * MIX
    return mixed(total)


def gram_counts(batches: Iterator[pd.DataFrame], order: int = ORDER) -> Iterator[pd.DataFrame]:
    """Counts of the longest n-grams by language; each text begins after order - 2 further spaces."""
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            found: dict[bytes, int] = defaultdict(int)
            for text in texts:
                codes = folded(text)
                if len(codes):
                    codes = np.concatenate((np.full(order - 2, SPACE, np.uint32), codes))
                    rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(codes, order)).view(f"V{4 * order}").ravel()
                    for gram, n in zip(*np.unique(rows, return_counts=True)):
                        found[gram.tobytes()] += int(n)
            yield pd.DataFrame({"lang": lang, "gram": [g.decode("utf-32-le") for g in found], "n": list(found.values())})


@dataclass
class Model:
    """Languages, and by order: sorted hashes, log2 probabilities, sorted context hashes, log2 weights."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    floor: float
    #: By language: mean cross-entropy of held-back texts, and its spread times the root of their length.
    usual: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))

    def log_probability(self, codes: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
        """For each position of ``at`` (the last character of an n-gram), a row of languages."""
        if order == 0:
            return np.full((len(at), len(self.languages)), self.floor, np.float32)
        own = keys(codes, order)[at - order + 1]
        table, values = self.grams[order - 1]
        place = np.minimum(np.searchsorted(table, own), len(table) - 1)
        out = values[place]
        missed = np.flatnonzero(table[place] != own)
        if len(missed):
            out[missed] = self.log_probability(codes, at[missed], order - 1)
            table, weights = self.contexts[order - 1]
            if order == 1:
                out[missed] += weights[0]
            else:
                own = keys(codes, order - 1)[at[missed] - order + 1]
                place = np.minimum(np.searchsorted(table, own), len(table) - 1)
                out[missed] += np.where((table[place] == own)[:, None], weights[place], np.float32(0))
        return out

    def cross_entropies(self, texts: list[np.ndarray]) -> np.ndarray:
        """Bits a character of each folded text (none empty) under each language."""
        pad = np.full(len(self.grams) - 2, SPACE, np.uint32)
        codes = np.concatenate([x for text in texts for x in (pad, text)])
        lengths = np.array([len(text) for text in texts])
        ends = (lengths + len(pad)).cumsum()
        inside = np.ones(len(codes), bool)
        for start, end in zip(ends - lengths, ends):  # the leading spaces are given, not predicted
            inside[start - len(pad) : start + 1] = False
        at = np.flatnonzero(inside)
        total = np.concatenate((np.zeros((1, len(self.languages))), self.log_probability(codes, at, len(self.grams)).cumsum(axis=0, dtype=np.float64)))
        last = (lengths - 1).cumsum()
        return (total[last - lengths + 1] - total[last]) / (lengths - 1)[:, None]


def _model(counts: dict[str, dict[str, int]], order: int) -> Model:
    """Interpolated Kneser-Ney estimates, with one discount an order, from counts of the longest n-grams."""
    languages = sorted(counts)
    symbols = {c for grams in counts.values() for g in grams for c in g}
    probability: list[list[dict[str, float]]] = []  # by order, by language
    weight: list[list[dict[str, float]]] = []
    tables: list[list[dict[str, int]]] = [[counts[lang] for lang in languages]]
    for _ in range(order - 1):  # how many characters precede each shorter n-gram
        shorter = []
        for longer in tables[0]:
            own: dict[str, int] = defaultdict(int)
            for gram in longer:
                own[gram[1:]] += 1
            shorter.append(own)
        tables.insert(0, shorter)
    floor = 1 / (len(symbols) + 1)
    for n, by_language in enumerate(tables, 1):
        union = set().union(*by_language)
        probability.append([])
        weight.append([])
        for at, own in enumerate(by_language):
            ones, twos = (sum(v == k for v in own.values()) for k in (1, 2))
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            total: dict[str, int] = defaultdict(int)
            kinds: dict[str, int] = defaultdict(int)
            for gram, c in own.items():
                total[gram[:-1]] += c
                kinds[gram[:-1]] += 1
            back = {context: discount * kinds[context] / total[context] for context in total}
            below = probability[n - 2][at] if n > 1 else None
            probability[-1].append({})
            for gram in union:
                context = gram[:-1]
                rest = floor if below is None else below[gram[1:]]
                p = max(own.get(gram, 0) - discount, 0) / total[context] + back[context] * rest if context in total else rest
                probability[-1][at][gram] = p
            weight[-1].append(back)
    grams, contexts = [], []
    for n in range(1, order + 1):
        names = list(probability[n - 1][0])
        h = keys_of(names)
        rank = h.argsort()
        grams.append((h[rank], np.log2(np.array([[own[g] for own in probability[n - 1]] for g in names], np.float64))[rank].astype(np.float32)))
        names = sorted(set().union(*weight[n - 1]))
        h = keys_of(names) if n > 1 else np.zeros(1, np.uint64)
        rank = h.argsort()
        contexts.append((h[rank], np.log2(np.array([[own.get(c, 1.0) for own in weight[n - 1]] for c in names], np.float64))[rank].astype(np.float32)))
    return Model(languages, grams, contexts, float(np.log2(floor)))


def keys_of(grams: list[str]) -> np.ndarray:
    """Hashes of n-grams of one length."""
    width = len(grams[0])
    codes = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(-1, width)
    total = np.full(len(grams), np.uint64(width), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            total = (total + codes[:, k].astype(np.uint64)) * MIX
    return mixed(total)


def training_rows(df: DataFrame, id_column: str, text: str, lang: str, usable: Column, max_rows: int) -> DataFrame:
    """At most about ``max_rows`` rows of each language (ties of the hash stay), found without moving texts."""
    from pyspark.sql import Window

    order = F.xxhash64(F.col(id_column))
    rows = df.where(usable & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), order.alias("pick"))
    # hashes are even, so of n rows the share 2 * max_rows / n that lies lowest holds the max_rows least
    sizes = rows.groupBy(F.col("lang").alias("its")).agg(F.count("*").alias("n"))
    lowest = F.lit(-(2.0**63)) + F.lit(2.0**64) * F.least(F.lit(1.0), 2.0 * max_rows / F.col("n"))
    few = rows.select("lang", "pick").join(F.broadcast(sizes), (F.col("lang") == F.col("its")) & (F.col("pick").cast("double") <= lowest))
    ranked = few.select("lang", "pick").withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("pick"))).where(F.col("place") <= max_rows)
    limits = ranked.groupBy("lang").agg(F.max("pick").alias("most")).withColumnRenamed("lang", "its")
    # a row for each language, as the model has; without texts being moved
    return rows.join(F.broadcast(limits), (F.col("lang") == F.col("its")) & (F.col("pick") <= F.col("most"))).select("lang", "text", "pick")


def fit(df: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", usable: Column | None = None, max_rows: int = MAX_ROWS, order: int = ORDER) -> Model | None:
    """A model of every language; one training text in five calibrates the rejection instead of being counted."""
    rows = training_rows(narrowed(df, id_column, text, lang), id_column, text, lang, F.lit(True) if usable is None else usable, max_rows)
    held = F.pmod(F.shiftright(F.col("pick"), 8), F.lit(5)) == 0
    counted = rows.where(~held).select("lang", "text").mapInPandas(lambda b: gram_counts(b, order), "lang string, gram string, n long")
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for r in counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect():  # bounded by max_rows texts a language
        counts[r.lang][r.gram] = r.n
    if not counts:
        return None
    model = _model(counts, order)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = {lang: k for k, lang in enumerate(sent.value.languages)}
        for batch in batches:
            pairs = [(own[lang], codes) for lang, text in zip(batch["lang"], batch["text"]) if lang in own and len(codes := folded(text)) > 1]
            bits = [(k, len(c), sent.value.cross_entropies([c])[0, k]) for k, c in pairs]
            yield pd.DataFrame(bits, columns=["k", "n", "bits"]).astype({"k": "int64", "n": "int64", "bits": "float64"})

    usual = np.zeros((len(model.languages), 2))
    usual[:, 0] = -model.floor
    measured = rows.where(held).select("lang", "text").mapInPandas(measure, "k long, n long, bits double")
    mean = F.sum(F.col("bits") * F.col("n")) / F.sum("n")
    centred = measured.groupBy("k").agg(mean.alias("mean"), F.sum("n").alias("n"), F.sum(F.col("bits") * F.col("n")).alias("t"), F.sum(F.col("bits") * F.col("bits") * F.col("n")).alias("q"), F.count("*").alias("c"))
    for r in centred.collect():  # a row for each language
        usual[r.k] = r.mean, max(0.0, (r.q - 2 * r.mean * r.t + r.mean**2 * r.n) / r.c) ** 0.5
    model.usual = usual
    return model


def predictions(model: Model, texts: list[str | None], spread: float = 8.0, margin: float = 1.0) -> list[tuple[str, float, float | None, bool]]:
    """Language, score, bits a character and rejection of each text.

    The score is the winner's share among all languages' likelihoods, tempered to at most 20
    characters so that it stays informative. ``spread`` and ``margin`` say how far above its
    language's usual cross-entropy (in spreads at its length, plus bits) a text may lie.
    """
    out: list[tuple[str, float, float | None, bool]] = [(UNDETERMINED, 0.0, None, True)] * len(texts)
    for start, end in chunked((len(t or "") for t in texts), CHUNK):
        codes = [folded(t) for t in texts[start:end]]
        some = [i for i, c in enumerate(codes) if len(c)]
        if not some:
            continue
        bits = model.cross_entropies([codes[i] for i in some])
        best = bits.argmin(axis=1)
        for row, i in enumerate(some):
            n, k = len(codes[i]) - 1, best[row]
            score = 1 / np.exp2((bits[row, k] - bits[row]) * min(n, 20)).sum()
            mean, sd = model.usual[k]
            out[start + i] = model.languages[k], float(score), float(bits[row, k]), bool(bits[row, k] > mean + margin + spread * sd / n**0.5)
    return out


def predict(df: DataFrame, model: Model | None, text: str = "text", into: str = "language") -> DataFrame:
    """``df`` with a struct of the prediction for its whole text."""
    if model is None:
        return df.withColumn(into, F.lit(None).cast("struct<lang_pred:string,score:double,cross_entropy:double,rejected:boolean>")).withColumn(
            into, F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
        )
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(PREDICTION)
    def tell(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(predictions(sent.value, list(texts)), columns=["lang_pred", "score", "cross_entropy", "rejected"])

    return df.withColumn(into, tell(F.col(f"`{text}`")))
