"""Language identification by hierarchical discrimination.

A text is first given a language family; within it, one-versus-one linear
support vector machines separate the closely related languages. Features are
the relative frequencies of hashed byte bigrams and trigrams (ASCII letters in
lower case) of the whole text, so every machine is one table of weights and a
text's score is the mean of the weights met.

Training takes a bounded sample: about ``SAMPLE`` distinct labelled texts of every
language, chosen by a hash of the text, and about ``TOTAL`` of all (with many
languages each has fewer, two at least). Every labelled language is learned, and
what is trained grows with their number only. Prediction covers every row and
looks at the text only.

Null texts and texts without a letter get ``und`` with score 0, as does
everything when no labelled row exists. Of languages with equal votes the one that
won its closest decision more clearly is taken, of equal families and languages the
first by name. Repeated rows, and rows with equal or missing ids, make no
difference: a text is in the sample once. Very long texts are read whole. Extra
columns stay as they are; ones named lang_pred or score are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .words import LOWER, text_slices

#: Texts of a language that training sees, about; and of all languages.
SAMPLE = 256
TOTAL = 4096
#: Hashed features of each order of n-gram.
DIM = 1 << 12
UNDETERMINED = "und"

# Families of the languages; any other language is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb"],
    "romance": ["fr", "es", "it", "pt", "ca", "ro", "gl", "oc", "la"],
    "slavic": ["ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz", "ky", "tk"],
    "indo-aryan": ["hi", "ur", "bn", "mr", "gu", "pa", "ne", "si"],
}


def family(lang: str) -> str:
    return next((f for f, own in FAMILIES.items() if lang.split("-")[0].lower() in own), lang)


def grams(data: np.ndarray, text_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed bigrams and trigrams at each byte, and whether they lie within one text."""
    x = np.concatenate([LOWER[data], np.zeros(2, np.uint8)]).astype(np.uint32)
    n = len(data)
    two = (x[:n] << np.uint32(8)) | x[1 : n + 1]
    three = (two << np.uint32(8)) | x[2 : n + 2]
    two = (two * np.uint32(2654435761)) >> np.uint32(32 - 12)
    three = ((three * np.uint32(2246822519)) >> np.uint32(32 - 12)) + np.uint32(DIM)
    in_two, in_three = np.ones(n, bool), np.ones(n, bool)
    ends = text_at[1:][np.diff(text_at) > 0]
    in_two[ends - 1] = in_three[ends - 1] = False
    longer = text_at[1:][np.diff(text_at) > 1]
    in_three[longer - 2] = False
    return two, three, in_two, in_three


def features(data: np.ndarray) -> np.ndarray:
    """The 2 * DIM relative frequencies of one text."""
    two, three, a, b = grams(data, np.array([0, len(data)]))
    out = np.zeros(2 * DIM, np.float32)
    for g, ok in ((two, a), (three, b)):
        if ok.any():
            out += np.bincount(g[ok], minlength=2 * DIM).astype(np.float32) / ok.sum()
    return out


def svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, passes: int = 60) -> tuple[np.ndarray, float]:
    """Linear SVM with hinge loss by dual coordinate descent (rows scaled by the caller); weights and bias."""
    gram = x @ x.T + 1.0
    alpha, f = np.zeros(len(y)), np.zeros(len(y))
    for _ in range(passes):
        moved = 0.0
        for i in range(len(y)):
            new = min(c, max(0.0, alpha[i] - (y[i] * f[i] - 1.0) / gram[i, i]))
            if new != alpha[i]:
                f += (new - alpha[i]) * y[i] * gram[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4 * c:
            break
    return x.T @ (alpha * y), float(alpha @ y)


@dataclass
class Model:
    langs: list[str]
    #: Of each machine: the labels that it separates (families, or two languages) and its place.
    families: list[str] = field(default_factory=list)
    machines: list[tuple[str, str]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 2 * DIM)))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))


def train(rows: list[tuple[str, np.ndarray]]) -> Model:
    """Families one-versus-rest, then each family's languages one-versus-one."""
    langs = sorted({lang for lang, _ in rows})
    model = Model(langs, sorted({family(lang) for lang in langs}))
    if len(langs) < 2:
        return model
    x = np.array([f for _, f in rows], np.float64)
    scale = 1.0 / (x.std(axis=0) + 1e-4)
    centre = x.mean(axis=0)
    x -= centre
    x *= scale
    z, unit = x, 1.0 / np.sqrt(np.einsum("ij,ij->i", x, x).mean())
    z *= unit
    lang = np.array([a for a, _ in rows])
    kin = np.array([family(a) for a, _ in rows])
    weights, bias = [], []

    def fit(use: np.ndarray, positive: np.ndarray, names: tuple[str, str]) -> None:
        w, b = svm(z[use], np.where(positive[use], 1.0, -1.0), c=10.0)
        w = w * scale * unit
        model.machines.append(names)
        weights.append(w)
        bias.append(b - float(centre @ w))

    everything = np.ones(len(rows), bool)
    for i, f in enumerate(model.families):
        if len(model.families) > 2 or (len(model.families) == 2 and i == 0):
            fit(everything, kin == f, ("family", f))
    for f in model.families:
        own = [a for a in langs if family(a) == f]
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                fit((lang == a) | (lang == b), lang == a, (a, b))
    model.weights, model.bias = np.array(weights), np.array(bias)
    return model


def margins(model: Model, data: np.ndarray, text_at: np.ndarray) -> np.ndarray:
    """Score of every machine for every text."""
    two, three, a, b = grams(data, text_at)
    n = len(text_at) - 1
    out = np.tile(model.bias, (n, 1))
    for g, ok in ((two, a), (three, b)):
        at = np.concatenate([[0], np.cumsum(ok)])[text_at]
        count = np.maximum(np.diff(at), 1)
        g = g[ok]
        for k, w in enumerate(model.weights):
            total = np.concatenate([[0.0], np.cumsum(w[g])])[at]
            out[:, k] += np.diff(total) / count
    return out


def decide(model: Model, m: np.ndarray) -> list[tuple[str, float]]:
    """Language and score of each row of margins."""
    p = 1.0 / (1.0 + np.exp(-np.clip(2.0 * m, -60, 60)))
    place = {names: k for k, names in enumerate(model.machines)}
    if len(model.families) == 2:
        first = p[:, place["family", model.families[0]]]
        kin_p = np.stack([first, 1 - first], axis=1)
    elif len(model.families) > 2:
        kin_p = np.stack([p[:, place["family", f]] for f in model.families], axis=1)
    else:
        kin_p = np.ones((len(m), 1))
    out: list[tuple[str, float]] = [("", 0.0)] * len(m)
    best = kin_p.argmax(axis=1)
    for j, f in enumerate(model.families):
        rows = np.flatnonzero(best == j)
        own = [a for a in model.langs if family(a) == f]
        votes, worth = np.zeros((len(rows), len(own))), np.ones((len(rows), len(own)))
        for x, a in enumerate(own):
            for y in range(x + 1, len(own)):
                q = p[rows, place[a, own[y]]]
                votes[:, x] += q >= 0.5
                votes[:, y] += q < 0.5
                worth[:, x] = np.minimum(worth[:, x], q)
                worth[:, y] = np.minimum(worth[:, y], 1 - q)
        pick = (votes + worth * 0.5).argmax(axis=1)
        for r, k in zip(rows.tolist(), pick.tolist(), strict=True):
            at = int(np.searchsorted(rows, r))
            out[r] = (own[k], float(kin_p[r, j] * worth[at, k]))
    return out


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def has_letter(data: np.ndarray, text_at: np.ndarray) -> np.ndarray:
    letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])[text_at]
    out = np.diff(letters) > 0
    for i in np.flatnonzero(~out & (np.diff(text_at) > 0)).tolist():
        out[i] = any(c.isalpha() for c in data[text_at[i] : text_at[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, total: int = TOTAL) -> Model:
    """A model of the labelled rows of ``docs`` (the caller leaves held-out rows away)."""
    labelled = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("lang is not null and text is not null")
    counts = labelled.groupBy("lang").agg(F.count_distinct(F.xxhash64("text")).alias("count")).collect()  # one row a language
    if not counts:
        return train([])
    # A share of the hash range that surely holds `each` texts of every language, and of these the first by hash.
    each = min(sample, max(2, total // len(counts)))
    span = 1 << 30
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(math.ceil(min(1.0, (4 * each + 20) / r["count"]) * span)))])
    h = F.pmod(F.xxhash64(F.col("text"), F.lit("language sample")), F.lit(span))
    some = labelled.select("lang", "text", h.alias("h")).filter(F.col("h") < share[F.col("lang")]).distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    chosen = some.withColumn("place", place).filter(F.col("place") <= each).select("lang", "text")

    def run(batches):
        for batch in batches:
            for rows, data, at in text_slices(batch, "text"):
                ok = has_letter(data, at)
                for k, lang in enumerate(rows.column(0).to_pylist()):
                    if ok[k]:
                        yield pa.RecordBatch.from_pydict({"lang": [lang], "f": [features(data[at[k] : at[k + 1]]).tobytes()]})

    got = chosen.mapInArrow(run, "lang string, f binary").collect()  # about `total` rows, two a language at least
    rows = sorted((r["lang"], bytes(r["f"])) for r in got)
    return train([(lang, np.frombuffer(f, np.float32)) for lang, f in rows])


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score from the text alone; other columns stay (clashing ones are replaced)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 64 KB a machine: one a family, one a pair of a family's languages
    docs = docs.drop("lang_pred", "score")

    def run(batches):
        m = sent.value
        for batch in batches:
            for rows, data, at in text_slices(batch, text_col):
                ok = has_letter(data, at)
                if not m.langs:
                    got = [(UNDETERMINED, 0.0)] * len(ok)
                elif len(m.langs) == 1:
                    got = [(m.langs[0], 1.0)] * len(ok)
                else:
                    got = decide(m, margins(m, data, at))
                got = [x if k else (UNDETERMINED, 0.0) for x, k in zip(got, ok.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())],
                    names=[*rows.schema.names, "lang_pred", "score"],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learns from the rows that are not held out and predicts all: id, held_out, lang_pred, score."""
    model = fit(docs.filter(~held_out(id_col)), id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("doc"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return predict(rows, model).select(F.col("doc").alias(id_col), "held_out", "lang_pred", "score")
