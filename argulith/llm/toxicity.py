"""Toxicity by compression distance: a window compresses better with a dictionary of its own kind.

Two zstandard dictionaries are trained, one on windows of ordinary and one on windows of toxic text. A class's
windows are of two sorts: those the other class could have said too, and those around a word that it never
says. Each sort trains a part of the dictionary. The first is the same for both classes, so lengths
differ hardly anywhere but where a text speaks like one class only. How large the second may be is chosen,
and a logistic threshold set, on labelled texts that trained nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from argulith.llm.common import fold, query, spare, table, with_text_columns
from argulith.session import stage

SAMPLE_DOCS = 2_000  # labelled texts per class that train the dictionaries; as many calibrate
SAMPLE_CHARS = 16_000  # longer texts are not in that sample; every text is scored whole
WINDOW = 64  # bytes, to the end of a word
COMMON_BYTES = 65_536  # of the part that both classes share
OWN_BYTES = (512, 1_024, 2_048, 4_096)  # sizes of a class's own part to choose from
OWN_WORDS = 2  # words of a training window
MIN_WINDOWS = 6  # distinct windows around a word that make them more than chance
LEVEL = 15
SEED = 42
FOLDS, HELD_OUT = 5, 0
FEATURES = ["mean", "most", "excess"]


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def windows(text: str | None, width: int | None = None) -> list[bytes]:
    """The whole text in pieces of ``width`` bytes, each to the end of its last word."""
    line = b" " + b" ".join(words_of(text)) + b" "
    width, cuts, at = width or WINDOW, [], 0
    while at < len(line) - 1:
        end = line.find(b" ", at + width, at + 2 * width)
        end = end if end >= 0 else min(at + 2 * width, len(line) - 1)  # no blank: an endless word, or the end
        cuts.append(line[at : end + 1])
        at = end
    return cuts


def lines(texts: Iterable[str]) -> Iterator[list[bytes]]:
    """The words of every distinct line: copies and passages that documents share count once."""
    seen: set[bytes] = set()
    for text in texts:
        for line in text.encode().lower().split(b"\n"):
            digest = blake2b(line, digest_size=16).digest()
            if digest not in seen:
                seen.add(digest)
                yield line.split()


def joined(words: list[bytes]) -> bytes:
    return b" " + b" ".join(words) + b" "


def own_windows(texts: list[str], others: set[bytes]) -> list[bytes]:
    """Distinct windows around words that the other class never says, if the word has several of them."""
    around: dict[bytes, set[bytes]] = defaultdict(set)
    for words in lines(texts):
        for at, word in enumerate(words):
            if word not in others and 3 <= len(word) <= 32:
                low = max(0, at - OWN_WORDS // 2)
                around[word].add(joined(words[low : low + OWN_WORDS]))
    return [w for word in sorted(around) if len(around[word]) >= MIN_WINDOWS for w in sorted(around[word])]


def shared_windows(texts: list[str], both: set[bytes]) -> list[bytes]:
    """Distinct windows of words that both classes say."""
    found: dict[bytes, None] = {}
    for words in lines(texts):
        for at in range(0, len(words), OWN_WORDS):
            part = words[at : at + OWN_WORDS]
            if both.issuperset(part):
                found[joined(part)] = None
    return [w for w in found if len(w) >= 8]


def trained(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary of the samples; the samples themselves if they are too few for one."""
    import zstandard

    order = np.random.default_rng(SEED).permutation(len(samples))
    try:
        return zstandard.train_dictionary(size, [samples[i] for i in order]).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def dictionaries(ordinary: list[str], toxic: list[str]) -> tuple[bytes, bytes]:
    """The two dictionaries with the largest own parts."""
    return dictionary_pairs(ordinary, toxic, OWN_BYTES[-1:])[0]


def dictionary_pairs(ordinary: list[str], toxic: list[str], sizes: tuple[int, ...] = OWN_BYTES) -> list[tuple[bytes, bytes]]:
    """The two dictionaries, for every size of their own parts."""
    said = [{w for t in texts for w in words_of(t)} for texts in (ordinary, toxic)]
    shared = trained(shared_windows(ordinary + toxic, said[0] & said[1]), COMMON_BYTES)
    own = own_windows(ordinary, said[1]), own_windows(toxic, said[0])
    pairs = []
    for size in sizes:
        parts = [trained(windows, size) for windows in own]
        longest = max(map(len, parts))  # distances into the shared part are the same in both
        pairs.append(tuple(part.rjust(longest) + shared for part in parts))
    return pairs


def compressor(dictionary: bytes):
    import zstandard

    bare = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    parameters = zstandard.ZstdCompressionParameters.from_level(LEVEL, **bare)
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=parameters).compress


def measure(text: str | None, ordinary, toxic) -> tuple[float, float, float]:
    """Mean, largest and summed excess of what the toxic dictionary saves over the ordinary one."""
    saved = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)], dtype=float)
    if not len(saved):
        return 0.0, 0.0, 0.0
    return float(saved.mean()), float(saved.max()), float(np.maximum(saved - 2, 0).sum() / np.sqrt(len(saved) + 3))


def with_features(df: DataFrame, text: str, pairs: list[tuple[bytes, bytes]]) -> DataFrame:
    """``df`` with the features of whole texts, an array per feature with a number per pair; null and empty texts have zeros."""
    held: list = []

    def run(texts: list) -> list[pa.Array]:
        if not held:
            held.extend([compressor(d) for d in pair] for pair in pairs)
        rows = [list(zip(*[measure(t, *pair) for pair in held])) for t in texts]
        return [pa.array([row[n] for row in rows], pa.list_(pa.float64())) for n in range(len(FEATURES))]

    fields = [StructField(spare(f, df.columns), ArrayType(DoubleType(), False), False) for f in FEATURES]
    return with_text_columns(df, text, StructType(fields), run)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Intercept and coefficients of a ridge logistic regression of few features, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, penalty = np.zeros(x.shape[1]), np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty @ beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


class CompressionModel:
    """Two dictionaries and a calibrated threshold."""

    def __init__(self, pair: tuple[bytes, bytes] | None, beta: np.ndarray) -> None:
        self.pair, self.beta = pair, [float(b) for b in beta]

    def score(self, df: DataFrame, text: str = "text") -> DataFrame:
        """``df`` with ``score`` (0 to 1, higher: toxic likelier) and ``predicted`` (1 if score >= 0.5).

        Whole texts are scored. Null and empty texts have no windows and get the score of zero
        features. Repeated rows are scored one by one, an empty table gives no rows, other columns stay as
        they are and the new ones get underscores where names clash. A model fitted without both classes scores 0.
        """
        taken = list(df.columns)
        score, predicted = spare("score", taken), spare("predicted", taken)
        kept = [F.col(f"`{c}`") for c in taken]
        if self.pair is None:
            return df.select(*kept, F.lit(0.0).alias(score), F.lit(0).alias(predicted))
        names = [spare(f, taken) for f in FEATURES]
        line = sum((F.col(n)[0] * b for n, b in zip(names, self.beta[1:])), F.lit(self.beta[0]))
        chance = 1 / (1 + F.exp(-line))
        scored = with_features(df, text, [self.pair]).select(*kept, chance.alias(score))
        return scored.withColumn(predicted, (F.col(score) >= 0.5).cast("int"))


def sampled_texts(documents: DataFrame, known: DataFrame, key: str, text: str, sample_docs: int) -> DataFrame:
    """``(label, calibrates, share, text)``: a hash sample of the labelled texts of ordinary length.

    Keys and lengths are joined, not texts; the texts of the chosen keys (about ``sample_docs`` per
    class and use at most) are then picked from the scan by a broadcast of those keys. A key that is
    repeated counts once, with its least text.
    """
    order = F.xxhash64(F.lit(SEED), F.col("key"))
    fitting = documents.select(F.col(key).alias("key"), F.length(text).alias("chars")).filter(
        F.col("chars").between(1, SAMPLE_CHARS)
    )
    labelled = known.filter(F.col("label").isin(0, 1)).select(F.col(key).alias("key"), F.col("label").cast("int").alias("label"))
    usable = (
        fitting.join(labelled, "key")
        .groupBy("key")
        .agg(F.min("label").alias("label"))
        .withColumn("calibrates", F.pmod(order, F.lit(4)) == 0)
        .withColumn("at", F.shiftrightunsigned(order, 11).cast("double") / float(1 << 53))
    )
    sizes = usable.groupBy("label", "calibrates").agg(F.count(F.lit(1)).alias("share"))
    chosen = usable.join(F.broadcast(sizes), ["label", "calibrates"]).filter(F.col("at") * F.col("share") < sample_docs)
    keys = F.broadcast(chosen.select("key", "label", "calibrates", "share"))
    found = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).join(keys, "key")
    return (
        found.filter(F.length("text").between(1, SAMPLE_CHARS))
        .groupBy("key", "label", "calibrates", "share")
        .agg(F.min("text").alias("text"))
    )


def fit(
    documents: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS
) -> CompressionModel:
    """A model from documents and ``known`` labels (key, ``label``: 1 toxic, 0 ordinary, others ignored).

    Per class, a hash sample of about ``sample_docs`` texts of 1 to ``SAMPLE_CHARS`` characters at
    most trains the dictionaries; another, one labelled text in four, chooses the size of their own parts
    and calibrates, weighted back to its class's share. So about 2 x ``sample_docs`` texts reach the driver.
    """
    sample = stage(sampled_texts(documents, known, key, text, sample_docs), "labelled")
    texts = [
        [r["text"] for r in sample.filter((F.col("label") == kind) & ~F.col("calibrates")).orderBy("key").collect()]
        for kind in (0, 1)
    ]
    if not texts[0] or not texts[1]:
        return CompressionModel(None, np.zeros(1 + len(FEATURES)))
    pairs = dictionary_pairs(*texts)
    seen = sample.filter("calibrates").repartition(documents.sparkSession.sparkContext.defaultParallelism)
    rows = with_features(seen, "text", pairs).select("label", "share", *FEATURES).collect()
    y = np.array([r["label"] for r in rows], dtype=float)
    if len(set(y)) < 2:
        return CompressionModel(None, np.zeros(1 + len(FEATURES)))
    weight = np.array([r["share"] / (y == r["label"]).sum() for r in rows])
    weight *= len(y) / weight.sum()
    best = None
    for n, pair in enumerate(pairs):
        x = np.array([[r[f][n] for f in FEATURES] for r in rows])
        beta = logistic(x, y, weight)
        line = beta[0] + x @ beta[1:]
        loss = float((weight * np.logaddexp(0, np.where(y == 1, -line, line))).sum())
        if best is None or loss < best[0]:
            best = loss, pair, beta
    return CompressionModel(*best[1:])


def held_out(key: str) -> Column:
    """Rows that no label is learned from; false for a null key."""
    return F.coalesce(fold(F.col(key), FOLDS) == HELD_OUT, F.lit(False))


def fit_toxicity(documents: DataFrame, labels: DataFrame) -> CompressionModel:
    """The model of ``labels.toxic`` from the documents that are not held out."""
    known = labels.select(F.col("doc_id"), F.col("toxic").alias("label")).filter(~held_out("doc_id"))
    return fit(documents, known)


@query("op9_toxicity")
def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every whole document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(documents, table(spark, sf_dir, "labels"))
    return model.score(documents).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
