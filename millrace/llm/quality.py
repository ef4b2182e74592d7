"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

A document's own evidence comes from two logistic models, fitted to a bounded sample
of labelled rows: one of quality, over the shape of the text, and one of toxicity,
over words and word beginnings that toxic texts have more often. Both give the
document's chance to be good. Sums of these chances by host and by path within
the host then say how good a site is: a path's mean is shrunk toward its host's and
a host's toward the mean of all, the more the fewer documents it has, by weights
estimated from the spread between sites. In the end the document's odds are
multiplied by what the site's odds exceed those of all.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import materialise

#: Labelled rows that the models are fitted to: those whose ids hash lowest.
SAMPLE_ROWS = 20_000
#: Words and beginnings kept as signs of toxicity, how often each must be seen and its least log ratio.
SIGNS, SIGN_SEEN, SIGN_RATIO = 5_000, 4, 2.0
KEEP_FROM = 0.5
#: Site chances are held within these bounds before their odds are taken.
SITE_BOUNDS = (0.02, 0.98)

_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
#: Signs of ASCII that running prose has little of.
_SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"
FEATURES = 11


class Logistic(NamedTuple):
    """Logistic model: means and scales of the features, their weights, and the constant."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    constant: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight + self.constant


class Model(NamedTuple):
    quality: Logistic
    toxic: Logistic
    signs: dict[bytes, float]


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split()


def signs_of(words: set[bytes]) -> set[bytes]:
    """What is counted of a text's distinct words: the words, and beginnings of four and five letters.

    Letters are bytes in UTF-8 here; a star marks a beginning.
    """
    return words | {w[:4] + b"*" for w in words} | {w[:5] + b"*" for w in words}


def shape(text: str, words: list[bytes], distinct: set[bytes]) -> list[float]:
    """Features of a text that has words: shares of signs, capitals, repeats and the like."""
    data = text.encode("utf-8", "surrogatepass")
    size, n = len(data), len(words)
    lines = text.split("\n")
    symbols = (size - len(data.translate(None, _SYMBOLS))) / size
    return [
        math.log1p(n),
        symbols,
        math.sqrt(symbols),
        (size - len(data.translate(None, _UPPER))) / size,
        (size - len(data.translate(None, _DIGITS))) / size,
        math.sqrt(data.count(b"!") / size),
        len(distinct) / n,
        math.log(len(distinct) + 1) / math.log(n + 1.5),
        sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines),
        sum(map(len, words)) / n,
    ]


def signal(distinct: set[bytes], signs: dict[bytes, float]) -> list[float]:
    """Features of toxicity: the log ratios of the signs that a text has, summed, the largest, and their number."""
    found = [signs[s] for s in signs_of(distinct) & signs.keys()]
    return [math.log1p(sum(found)), max(found, default=0.0), math.log1p(len(found))]


def fit_logistic(x: np.ndarray, y: np.ndarray, added: tuple[float, float], ridge: float = 1.0) -> Logistic:
    """Newton's method with a ridge. Without both classes only the constant is set, after ``added`` ones and zeros."""
    n = x.shape[1]
    prior = math.log((y.sum() + added[0]) / (len(y) - y.sum() + added[1]))
    if not 0 < y.sum() < len(y):
        return Logistic(np.zeros(n), np.ones(n), np.zeros(n), prior)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])
    weight = np.append(np.zeros(n), prior)
    penalty = np.diag(np.append(np.full(n, ridge), 1e-6))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ weight, -30, 30)))
        slope = z.T @ (p - y) + penalty @ weight
        curve = (z * (p * (1 - p))[:, None]).T @ z + penalty
        step = np.linalg.solve(curve, slope)
        weight -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(mean, scale, weight[:-1], float(weight[-1]))


def _counted_signs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            counts[toxic].update(signs_of(set(words_of(text or ""))))
    for toxic, found in counts.items():
        for i in range(0, len(found), 50_000):
            some = list(found.items())[i : i + 50_000]
            yield pd.DataFrame({"sign": [s for s, _ in some], "toxic": toxic, "n": [c for _, c in some]})


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Models from the texts of at most ``sample_rows`` labelled rows.

    ``labels`` has ``doc_id, quality, toxic`` (0 or 1); rows with a null are passed
    over, repeated ones count again. Signs are learned from one half of the sample
    and weighted on the other. Without labelled rows every text with words is good.
    """
    known = labels.select("doc_id", "quality", "toxic").dropna()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "toxic").limit(sample_rows)
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half")
    sample = materialise(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality", "toxic", half)
    )
    signs = _signs(sample.where("half = 0"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, quality, toxic, half in batch.itertuples(index=False):
                words = words_of(text or "")
                if words:
                    distinct = set(words)
                    rows.append((doc_id, int(quality), int(toxic), half, shape(text, words, distinct) + signal(distinct, signs)))
            yield pd.DataFrame(rows, columns=["doc_id", "quality", "toxic", "half", "x"])

    rows = sample.mapInPandas(features, "doc_id long, quality int, toxic int, half long, x array<double>")
    found = rows.sort("doc_id", "quality", "toxic").toPandas()
    x = np.array(found["x"].tolist(), dtype=float).reshape(-1, FEATURES + 3)
    own = (found["half"] == 1).to_numpy()
    return Model(
        fit_logistic(x[:, :FEATURES], found["quality"].to_numpy(), (2.0, 1.0)),
        fit_logistic(x[own, FEATURES:], found["toxic"].to_numpy()[own], (0.1, 1.0)),
        signs,
    )


def _signs(sample: DataFrame) -> dict[bytes, float]:
    """The signs that speak most for toxicity, with the log ratio of their shares."""
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return {}
    counted = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInPandas(
        _counted_signs, "sign binary, toxic int, n long"
    )
    by_sign = counted.groupBy("sign").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum("n").alias("n")
    )
    share = (F.col("bad") + 0.1) / (bad + 0.2)
    other = (F.col("n") - F.col("bad") + 0.1) / (good + 0.2)
    ranked = by_sign.where(F.col("bad") >= SIGN_SEEN).withColumn("ratio", F.log(share / other))
    kept = ranked.where(F.col("ratio") >= SIGN_RATIO).orderBy(F.desc(F.col("ratio") * F.col("bad")), "sign").limit(SIGNS)
    return {bytes(r["sign"]): r["ratio"] for r in kept.collect()}


def _evidence(docs: DataFrame, model: Model):
    """Column function from a text to ``(quality, toxic)``: the chances by the text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.StructType([T.StructField("quality", T.DoubleType()), T.StructField("toxic", T.DoubleType())]))
    def judge(texts: pd.Series) -> pd.DataFrame:
        model = sent.value
        x = np.zeros((len(texts), FEATURES + 3))
        empty = np.zeros(len(texts), dtype=bool)
        for i, text in enumerate(texts):
            words = words_of(text or "")
            if words:
                distinct = set(words)
                x[i] = shape(text, words, distinct) + signal(distinct, model.signs)
            else:
                empty[i] = True
        chance = lambda logit: 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        quality = np.where(empty, 0.0, chance(model.quality.logit(x[:, :FEATURES])))
        toxic = np.where(empty, 0.0, chance(model.toxic.logit(x[:, FEATURES:])))
        return pd.DataFrame({"quality": quality, "toxic": toxic})

    return judge


def _good() -> Column:
    return F.col("__e.quality") * (1 - F.col("__e.toxic"))


def site_posteriors(chances: DataFrame, host: str, path: str) -> tuple[DataFrame, float]:
    """Per ``host`` and ``path``: their shrunk means ``host_posterior, path_posterior``; and the mean of all.

    ``chances`` has both columns and ``p``. Nulls are a site of their own. A level's
    weight is the number of documents that its prior counts for; it follows from
    the variance between the level's means beyond what their sizes explain.
    """
    sites = materialise(
        chances.groupBy(F.col(host).alias("__host"), F.col(path).alias("__path")).agg(
            F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")
        )
    )
    hosts = materialise(sites.groupBy("__host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("q").alias("hq")))
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s")).first()
    mean = (total["s"] + 0.5) / (total["n"] + 1) if total["n"] else 0.5
    both = sites.join(hosts, sites["__host"].eqNullSafe(hosts["__host"])).drop(hosts["__host"])
    host_weight = _prior_weight(hosts, "hn", "hs", "hq", F.lit(mean), mean)
    path_weight = _prior_weight(both, "n", "s", "q", F.col("hs") / F.col("hn"), mean)
    host_mean = (F.lit(host_weight * mean) + F.col("hs")) / (F.lit(host_weight) + F.col("hn"))
    own = both.withColumn("host_posterior", host_mean)
    path_mean = (F.lit(path_weight) * F.col("host_posterior") + F.col("s")) / (F.lit(path_weight) + F.col("n"))
    return materialise(own.select("__host", "__path", "host_posterior", path_mean.alias("path_posterior"))), mean


def _prior_weight(sites: DataFrame, n: str, s: str, q: str, centre: Column, mean: float) -> float:
    """Documents that the prior of a level counts for, by the method of moments."""
    count, own = F.col(n), F.col(s) / F.col(n)
    row = sites.agg(
        F.count("*").alias("sites"),
        F.sum(count).alias("n"),
        F.sum(count * count).alias("n2"),
        F.sum(count * (own - centre) * (own - centre)).alias("between"),
        F.sum(F.col(q) - F.col(s) * own).alias("within"),
    ).first()
    if not row["n"] or row["sites"] < 2 or row["n"] <= row["sites"]:
        return 10.0
    noise = max(0.0, row["within"]) / (row["n"] - row["sites"])
    spread = (row["between"] - (row["sites"] - 1) * noise) / (row["n"] - row["n2"] / row["n"])
    return float(np.clip(mean * (1 - mean) / max(spread, 1e-9) - 1, 1.0, 1e6))


def _judged(docs: DataFrame, model: Model, host: str, path: str) -> DataFrame:
    """``docs`` with evidence ``__e``, posteriors and ``__posterior``."""
    judge = _evidence(docs, model)
    chances = materialise(docs.select(host, path, judge("text").alias("__e")).select(host, path, _good().alias("p")))
    sites, mean = site_posteriors(chances, host, path)
    low, high = SITE_BOUNDS
    odds = lambda p: F.log(p / (1 - p))
    inside = lambda p: F.least(F.greatest(p, F.lit(low)), F.lit(high))
    own = F.least(F.greatest(_good(), F.lit(1e-9)), F.lit(1 - 1e-9))
    site = odds(inside(F.col("path_posterior"))) - odds(inside(F.lit(mean)))
    joined = docs.withColumn("__e", judge("text")).join(
        sites, docs[host].eqNullSafe(sites["__host"]) & docs[path].eqNullSafe(sites["__path"])
    )
    return joined.withColumn("__posterior", 1 / (1 + F.exp(-(odds(own) + site))))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row ``doc_id``, the chances by its text, its site's posteriors, the posterior and whether it is kept.

    A text without words (null and empty ones too) has quality 0 and is not kept.
    Null hosts and paths are sites like others. Repeated rows are judged alike.
    Only the named columns are read. No rows give no rows.
    """
    model = fit(docs, labels, sample_rows)
    judged = _judged(docs.select("doc_id", "text", host, path), model, host, path)
    return judged.select(
        "doc_id",
        F.col("__e.quality").alias("p_quality"),
        F.col("__e.toxic").alias("p_toxic"),
        "host_posterior",
        "path_posterior",
        F.col("__posterior").alias("posterior"),
        (F.col("__posterior") >= KEEP_FROM).alias("keep"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows of ``docs`` that ``classify`` keeps, with the columns of ``docs``.

    Names that start with two underscores are used on the way.
    """
    renamed = docs.select([F.col(c).alias(f"__c{i}") for i, c in enumerate(docs.columns)] + ["text", host, path])
    judged = _judged(renamed, fit(docs, labels, sample_rows), host, path).where(F.col("__posterior") >= KEEP_FROM)
    return judged.select([F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])
