"""Token counts from a digest cache.

1. Each text is normalised where it lies and becomes the digest of what is left; only digests and byte counts travel.
2. The digests meet the cache: a table of (tokenizer, digest, n_tokens) in a shared folder, where the tokenizer is the
   digest of its file, the library's version and the rule of normalising. What it lacks is a miss.
3. One text of each distinct miss is encoded, copies being merged before they are shuffled, and the counts are appended.
4. The rows take their counts from the cache by digest.

Normalising never changes a count: it is done only for tokenizers whose own file says that they fold white space and
case themselves, and only as far as that holds for any text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.session import shared_root, staged


@dataclass(frozen=True)
class CountParams:
    tokenizer: str | None = None  #: path of a tokenizers (.json) or sentencepiece (.model) file; None: word_bpe_49k.json of public_tokenizers
    limit: int = 2048  #: tokens of the longest text that is not over the limit
    cache_words: int = 400_000  #: words whose counts a worker remembers; speed only
    word_chars: int = 64  #: longer words aren't remembered
    broadcast_rows: int = 1 << 20  #: a list of misses is broadcast up to so many rows and joined by sorting beyond


def _path(params: CountParams) -> str:
    if params.tokenizer is not None:
        return params.tokenizer
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def folds(path: str) -> bool:
    """Whether the file's tokenizer takes any run of white space as one end of a word, drops it, and lowers case.

    Its special strings must match inside words as they stand, without taking white space with them. Then a text has
    the tokens of its words in turn.
    """
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    steps = (said.get("normalizer") or {}).get("normalizers", [])
    split = next(iter((said.get("pre_tokenizer") or {}).get("pretokenizers", [])), {})
    return (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": r"\s+"}, " ")
        and (split.get("type"), split.get("behavior"), split.get("invert")) == ("Split", "Removed", True)
        and split["pattern"].get("Regex", "").endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and not any(t["lstrip"] or t["rstrip"] or t["normalized"] or t["single_word"] or " " in t["content"] for t in said["added_tokens"])
    )


def normalised(body: Column, fold: bool) -> Column:
    """`body` with the same tokens: ASCII white space is one space, and none at the ends; ASCII texts lose their capitals.

    Texts with a part of a special string keep their capitals, since those match as they stand, and so do texts with
    other letters, since what composes with a small letter need not with a capital.
    """
    if not fold:
        return body
    spaced = F.trim(F.regexp_replace(body, r"[ \t\n\r]+", " "))
    plain = (F.octet_length(body) == F.char_length(body)) & ~body.contains("<|")
    return F.when(plain, F.lower(spaced)).otherwise(spaced)


def version(path: str) -> str:
    """The digest of all that a count depends on besides the text."""
    library = __import__("tokenizers" if path.endswith(".json") else "sentencepiece")
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + f"\n{library.__version__}\n{folds(path)}".encode()).hexdigest()


#: ASCII marks that end a word; the tokenizer keeps a run of them apart from the letters before it
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_letters() -> dict[int, int]:
    """Byte-level BPE's letter for each byte: itself if it prints, else the next free one from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + n for n, b in enumerate(hidden)}


class Counter:
    """Counts of one tokenizer; `count` gives those of a list of normalised texts.

    Of a tokenizer that `folds`, counts are remembered by word. A word of letters and marks after them is cut there,
    and its parts go straight to the merges, as the tokenizer does it; any other word goes to it as a whole.
    """

    def __init__(self, path: str, params: CountParams = CountParams()):
        self.fold, self.params = folds(path), params
        self.known: dict[str, int] = {}  # words
        self.parts: dict[str, int] = {}  # letters alone, and marks alone
        self.letters = _byte_letters()
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            inner = Tokenizer.from_file(path)
            inner.no_truncation()
            inner.no_padding()
            self.encode = lambda text: len(inner.encode(text, add_special_tokens=False).ids)
            self.merge, self.fit = inner.model.tokenize, inner.normalizer.normalize_str if self.fold else None
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda text: len(model.encode(text))

    def _part(self, part: str) -> int:
        if (n := self.parts.get(part)) is None:
            if len(self.parts) >= self.params.cache_words:
                self.parts.clear()
            spelt = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            n = len(self.merge(spelt))
            if len(part) <= self.params.word_chars:
                self.parts[part] = n
        return n

    def _word(self, word: str) -> int:
        core = word.rstrip(_MARKS)
        tail = word[len(core) :]
        if core and not core.isascii():
            core = self.fit(core)
        if not core.isalpha() or "<|" in tail:
            return self.encode(word)
        return self._part(core.lower() if core.isascii() else core) + (self._part(tail) if tail else 0)

    def _text(self, text: str) -> int:
        total, known = 0, self.known
        words = text.split(" ")
        for w in words:
            if (n := known.get(w)) is None:
                n = self._word(w)
                if len(w) <= self.params.word_chars:
                    if len(known) >= self.params.cache_words:
                        known.clear()
                    known[w] = n
            total += n
        return total

    def count(self, texts: list[str]) -> list[int]:
        return [self._text(t) for t in texts] if self.fold else [self.encode(t) for t in texts]


class TokenCache:
    """Counts by tokenizer and digest in a folder that driver and executors share.

    Files are only ever added, so jobs may share a cache; a digest that two of them added counts once. A job that fails
    adds nothing or a whole table.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder = spark, folder or f"{shared_root(spark)}/strandwise/{spark.sparkContext.applicationId}/token-cache-{uuid4().hex}"

    def _at(self, tokenizer: str) -> str:
        return f"{self.folder}/{tokenizer}"

    def counts(self, tokenizer: str) -> DataFrame:
        """(digest, n_tokens), a row for each digest."""
        schema = "digest binary, n_tokens long"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._at(tokenizer))
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._at(tokenizer)).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, tokenizer: str, counts: DataFrame) -> None:
        counts.write.mode("append").parquet(self._at(tokenizer))


def encoded(texts: DataFrame, path: str, params: CountParams) -> DataFrame:
    """(digest, n_tokens) of (digest, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, params)
        for batch in batches:
            n = [counter.count([t.as_py()])[0] for t in batch.column(1)]  # one text at a time is a Python string
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64())], names=["digest", "n_tokens"])

    return texts.mapInArrow(run, "digest binary, n_tokens long")


def count_tokens(docs: DataFrame, cache: TokenCache, id_col: str = "doc_id", text_col: str = "text", params: CountParams = CountParams()) -> DataFrame:
    """One row per row of `docs`: id_col, n_bytes (UTF-8), n_tokens, over_limit.

    Null text counts as empty: no bytes, no tokens. Rows with null ids and repeated rows are documents of their own;
    other columns are ignored, so they may have any names; an empty table gives no rows. A text must fit a task; one
    text may have any number of rows. Counts are the library's for whole texts, without begin, end or added tokens.
    """
    path = _path(params)
    fold, tokenizer = folds(path), version(path)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    body = normalised(F.col("body"), fold)
    digest = F.unhex(F.sha2(body, 256)).alias("digest")
    keys = staged(rows.select("id", F.octet_length("body").cast("long").alias("n_bytes"), digest), "digests")
    misses = staged(keys.select("digest").distinct().join(cache.counts(tokenizer), "digest", "left_anti"), "misses")
    if n := misses.count():
        texts, few = rows.select(digest, body.alias("body")), n <= params.broadcast_rows
        if few and n < keys.count():
            texts = texts.join(F.broadcast(misses), "digest", "left_semi")
        one = texts.groupBy("digest").agg(F.any_value("body").alias("body"))
        cache.append(tokenizer, encoded(one if few else one.join(misses, "digest", "left_semi"), path, params))
    counts = staged(cache.counts(tokenizer), "counts")  # as a table, so that a hot digest's rows can be split in the join
    return keys.join(counts, "digest").select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > params.limit).alias("over_limit"))


def op13_token_counts(spark, sf_dir: str) -> DataFrame:
    """The query's cache starts empty, so each run does all of its work; `count_tokens` takes a lasting one."""
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), TokenCache(spark))
