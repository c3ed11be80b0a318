"""Language identification by a byte convolutional network.

Texts are cut into fixed-length windows of UTF-8 bytes. Filters of several widths slide over byte embeddings, each
filter's largest response in a window is pooled, and a softmax over the pooled responses gives the language. The
network is trained in numpy by Adam on a bounded sample of labelled windows. To apply it, an even width becomes a sum
of look-ups by byte pair, and whole batches of windows go through together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageParams:
    sample_docs: int = 3000  #: labelled rows to learn from, shared out evenly over the languages: the fit's only bound
    sample_windows: int = 4  #: windows taken from each of them, spread over the text
    max_languages: int = 500  #: more different labels than this is an error
    window: int = 256  #: bytes
    widths: tuple[int, ...] = (2, 4, 6)  #: even numbers
    filters: int = 16  #: of each width
    embed: int = 8
    steps: int = 500
    batch: int = 64
    rate: float = 0.01
    seed: int = 11


@dataclass(frozen=True)
class ByteCnn:
    langs: tuple[str, ...]
    widths: tuple[int, ...]
    window: int
    embed: np.ndarray  #: 256 x embed
    kernels: tuple[np.ndarray, ...]  #: by width: width x embed x filters
    shifts: tuple[np.ndarray, ...]  #: by width: filters
    dense: np.ndarray  #: pooled x langs
    base: np.ndarray  #: langs


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter by Unicode; figures such as ½ or Ⅷ are none."""
    return bool(text) and (re.search("[A-Za-z]", text) is not None or any(map(str.isalpha, text)))


def windows_of(bodies: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts, zero-padded, and the number of windows of each text (1 at least)."""
    n = np.array([max(1, -(-len(b) // window)) for b in bodies], np.int64)
    flat = np.zeros(int(n.sum()) * window, np.uint8)
    at = 0
    for b, k in zip(bodies, n.tolist(), strict=True):
        flat[at : at + len(b)] = np.frombuffer(b, np.uint8)
        at += k * window
    return flat.reshape(-1, window), n


def train(windows: list[bytes], labels: list[str], params: LanguageParams) -> ByteCnn:
    """Fit by cross entropy. Every third window of a step is cut short, so that short texts are learnt too."""
    rng = np.random.default_rng(params.seed)
    langs = tuple(sorted(set(labels)))
    y = np.searchsorted(langs, labels)
    x = np.zeros((len(windows), params.window), np.uint8)
    for i, b in enumerate(windows):
        x[i, : len(b)] = np.frombuffer(b[: params.window], np.uint8)
    by_lang = [np.flatnonzero(y == k) for k in range(len(langs))]
    d, f = params.embed, params.filters
    w = {"embed": rng.normal(0, 0.3, (256, d)), "dense": rng.normal(0, 0.1, (f * len(params.widths), len(langs))), "base": np.zeros(len(langs))}
    for k in params.widths:
        w[f"k{k}"] = rng.normal(0, 1 / np.sqrt(k * d), (k, d, f))
        w[f"s{k}"] = np.zeros(f)
    w = {k: v.astype(np.float32) for k, v in w.items()}
    m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, params.steps + 1):
        if len(langs) < 2:
            break
        take = np.array([rng.choice(by_lang[k]) for k in rng.integers(0, len(langs), params.batch)])
        xb = x[take]
        for i in range(0, params.batch, 3):
            xb[i, int(rng.integers(8, params.window)) :] = 0
        xe = w["embed"][xb]
        pooled, best = [], []
        for k in params.widths:
            cols = np.lib.stride_tricks.sliding_window_view(xe, k, axis=1).transpose(0, 1, 3, 2).reshape(params.batch, -1, k * d)
            r = cols @ w[f"k{k}"].reshape(k * d, f) + w[f"s{k}"]
            best.append((r.argmax(axis=1), cols))
            pooled.append(np.maximum(r.max(axis=1), 0))
        p = np.concatenate(pooled, axis=1)
        z = p @ w["dense"] + w["base"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z /= z.sum(axis=1, keepdims=True)
        z[np.arange(params.batch), y[take]] -= 1
        z /= params.batch
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["dense"], g["base"] = p.T @ z, z.sum(axis=0)
        gp = (z @ w["dense"].T) * (p > 0)
        for j, k in enumerate(params.widths):
            at, cols = best[j]
            own = gp[:, j * f : (j + 1) * f]
            rows = np.take_along_axis(cols, at[:, :, None], axis=1)  # batch x filters x (k d)
            g[f"k{k}"] = np.einsum("bf,bfc->cf", own, rows).reshape(k, d, f)
            g[f"s{k}"] = own.sum(axis=0)
            back = own[:, :, None, None] * w[f"k{k}"].transpose(2, 0, 1)[None]
            seen = np.take_along_axis(xb[:, None, :], at[:, :, None] + np.arange(k), axis=2)
            np.add.at(g["embed"], seen.reshape(-1), back.reshape(-1, d))
        for k in w:
            m1[k] = 0.9 * m1[k] + 0.1 * g[k]
            m2[k] = 0.999 * m2[k] + 0.001 * g[k] ** 2
            w[k] -= params.rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return ByteCnn(langs, params.widths, params.window, w["embed"], tuple(w[f"k{k}"] for k in params.widths), tuple(w[f"s{k}"] for k in params.widths), w["dense"], w["base"])


class Applied:
    """A network with its filters as look-ups by byte pair."""

    def __init__(self, net: ByteCnn):
        self.net, self.tables = net, []
        for k, kernel, shift in zip(net.widths, net.kernels, net.shifts, strict=True):
            own = []
            for j in range(0, k, 2):
                t = (net.embed @ kernel[j])[:, None, :] + (net.embed @ kernel[j + 1])[None, :, :]
                own.append(np.ascontiguousarray((t + (shift if j == 0 else 0)).reshape(65536, -1), np.float32))
            self.tables.append(own)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """windows x langs"""
        out, step = [], max(1, (1 << 16) // self.net.window)
        for at in range(0, len(x), step):
            part = x[at : at + step].astype(np.intp)
            pair = part[:, :-1] << 8 | part[:, 1:]
            pooled = []
            for k, tables in zip(self.net.widths, self.tables, strict=True):
                n = self.net.window - k + 1
                r = np.take(tables[0], pair[:, :n], axis=0)
                for j, t in enumerate(tables[1:], 1):
                    r += np.take(t, pair[:, 2 * j : 2 * j + n], axis=0)
                pooled.append(np.maximum(r.max(axis=1), 0))
            z = np.concatenate(pooled, axis=1) @ self.net.dense + self.net.base
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out.append(z / z.sum(axis=1, keepdims=True))
        return np.concatenate(out)

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of whole texts: the mean of their windows' probabilities, weighted by bytes."""
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        kept = [i for i, t in enumerate(texts) if has_letter(t)] if self.net.langs else []
        at = 0
        while at < len(kept):  # about 2 MB of text at a time
            own, size = [], 0
            while at < len(kept) and size < 1 << 21:
                own.append(kept[at])
                size += len(texts[kept[at]])
                at += 1
            bodies = [texts[i].encode("utf-8", "replace") for i in own]
            x, n = windows_of(bodies, self.net.window)
            first = np.cumsum(n) - n
            weight = np.full(len(x), float(self.net.window))
            weight[first + n - 1] = [len(b) - (k - 1) * self.net.window for b, k in zip(bodies, n.tolist(), strict=True)]
            p = np.add.reduceat(self.probabilities(x) * weight[:, None], first) / np.add.reduceat(weight, first)[:, None]
            for i, k, s in zip(own, p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
                langs[i], scores[i] = self.net.langs[k], min(1.0, s)
        return langs, scores


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", order: Column | None = None, params: LanguageParams = LanguageParams()) -> ByteCnn:
    """A network from all rows of `labelled` with text and language, or a sample of them by the hash of `order`.

    What reaches the driver is the number of rows by language and, of about `sample_docs` rows, `sample_windows` windows
    each. A language with fewer rows than its share gives all of them; rows that share `order` and language count as one.
    More than `max_languages` different labels are an error.
    """
    rows = labelled.select(F.col(text_col).alias("body"), F.col(lang_col).alias("lang"), F.xxhash64(order if order is not None else F.col(text_col)).alias("h")).where(
        "lang IS NOT NULL AND length(body) > 0"
    )
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(params.max_languages + 1).collect()}
    if len(counts) > params.max_languages:
        raise ValueError(f"more than {params.max_languages} languages")
    if not counts:
        return train([], [], params)
    quota = -(-params.sample_docs // len(counts))
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1 << 20, -(-(quota << 20) // n)))).otherwise(share)
    cut = F.transform(
        F.sequence(F.lit(0), F.lit(params.sample_windows - 1)),
        lambda i: F.substring(F.col("body"), (F.length("body") * i / params.sample_windows).cast("int") + 1, F.lit(params.window)),
    )
    got = rows.where(F.pmod("h", F.lit(1 << 20)) < share).groupBy("lang", "h").agg(F.min(cut).alias("cut")).collect()
    pairs = sorted({(r["lang"], r["h"], w) for r in got for w in r["cut"] if has_letter(w)})
    return train([w.encode("utf-8", "replace")[: params.window] for _, _, w in pairs], [x for x, _, _ in pairs], params)


def identify(docs: DataFrame, net: ByteCnn, text_col: str = "text", lang_name: str = "lang_pred", score_name: str = "score", keep_text: bool = True) -> DataFrame:
    """`docs` with two more columns (which replace columns of these names): the language and its score.

    Null texts and texts without a letter are `und` with score 0, as are all where nothing was learnt.
    """
    rows = docs.drop(lang_name, score_name)
    kept = [c for c in rows.columns if keep_text or c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        applied = Applied(net)
        for batch in batches:
            langs, scores = applied(batch.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*kept, lang_name, score_name]
            )

    schema = StructType([StructField(f.name, f.dataType) for f in rows.schema.fields if f.name in kept])
    return rows.mapInArrow(run, schema.add(lang_name, "string").add(score_name, "double"))


def op5_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    net = learn(docs.where(fold("doc_id", 4) != 2), order=F.col("doc_id"))
    return identify(docs.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "text"), net, keep_text=False)
