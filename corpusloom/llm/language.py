"""Operator 9, language ID: the language whose dictionary compresses a text best.

Each language has a raw-content zstandard dictionary, made of passages of its own training documents. A text is cut into
blocks, every block is compressed on its own with each dictionary, and the language with the smallest sum of sizes wins. Blocks keep
a long text from becoming its own dictionary. The margin is the saving against the second best; narrow margins mark a row as rejected.

Limits: a dictionary holds ``passages`` passages of at most ``passage`` characters, from training documents with the smallest hashes;
where there are so many languages that this would take more than ``most_bytes`` in all, each has fewer and then shorter passages.
Every document is scored whole.

Defined cases: null text and text without a letter give ``und`` and score 0; equal sums go to the language first in code-point
order; languages without training text are not predicted, and with none at all every row is ``und``; a null id is not held out
and no example; of several texts of an id in a language one is the example, by its hash; repeated rows get equal results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import held_out, pieces

NOT_LETTERS = re.compile(r"[\W\d_]+")
BLOCK = 2048  # bytes
WIDEST = 4  # bytes of a character
LEVEL = 6


def normal(text: str) -> bytes:
    """Small letters, and one space for whatever stands between letters: what tells languages apart."""
    return NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


def dictionaries(docs: DataFrame, passages: int = 32, passage: int = 2000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", seed: int = 9, most_bytes: int = 32 << 20) -> dict[str, bytes]:
    """A dictionary for each language: a bounded draw of documents by the hash of their ids, a passage from inside each.

    Only ids and languages take part in the draw; a language's documents are thinned by its own count first, so that the
    ranked rows are few for every language, frequent or rare.
    """
    rows = docs.select(docs[id_col].alias("drawn_id"), docs[lang_col].cast("string").alias("lang"))
    rows = rows.where(F.col("drawn_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("drawn_id")))
    rows = rows.withColumn("u", F.shiftrightunsigned(F.xxhash64("drawn_id", F.lit(seed)), 11) / float(1 << 53))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    share = most_bytes // (WIDEST * max(1, counts.count()))  # characters of a language
    passages = max(1, min(passages, share // passage))
    passage = max(1, min(passage, share // passages))
    near = rows.join(F.broadcast(counts), "lang").where(F.col("u") * F.col("n") < 8 * passages)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("u", "drawn_id"))
    ids = near.select("drawn_id", "lang", "u").distinct().withColumn("rank", rank).where(F.col("rank") <= passages).select("drawn_id", "lang", "rank")
    text = docs[text_col]
    begin = F.greatest(F.lit(1), F.floor((F.length(text) - passage) / 2).cast("int"))
    own = docs.select(docs[id_col].alias("drawn_id"), docs[lang_col].cast("string").alias("lang"), F.substring(F.coalesce(text, F.lit("")), begin, F.lit(passage)).alias("passage"))
    found: dict[str, list[tuple[int, str]]] = {}
    one = F.min_by("passage", F.struct(F.xxhash64("passage"), "passage")).alias("passage")  # of several texts of an id
    for r in own.join(F.broadcast(ids), ["drawn_id", "lang"]).groupBy("lang", "rank").agg(one).collect():
        found.setdefault(r.lang, []).append((r.rank, r.passage))
    return {lang: b"".join(normal(p) for _, p in sorted(found[lang], reverse=True)) for lang in sorted(found)}


class Identifier:
    """Compressors primed with the dictionaries, made once in each Python worker."""

    def __init__(self, texts: dict[str, bytes]) -> None:
        self.languages = list(texts)
        self.compressors = []
        for text in texts.values():
            raw = zstandard.ZstdCompressionDict(text or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False))

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0
        data = normal(text)
        sums = [0] * len(self.languages)
        for lo in range(0, len(data), BLOCK):
            block = data[lo : lo + BLOCK]
            for k, c in enumerate(self.compressors):
                sums[k] += len(c.compress(block))
        best = min(range(len(sums)), key=sums.__getitem__)
        others = sums[:best] + sums[best + 1 :]
        margin = 1 - sums[best] / min(others) if others else 1.0
        return self.languages[best], min(1.0, 0.5 + 5 * margin), margin


def identify(docs: DataFrame, texts: dict[str, bytes], least_margin: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``: rejected where the margin is below ``least_margin``."""
    rows = docs.select(docs[id_col].alias("doc_id"), held_out(docs[id_col]).alias("held_out"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(texts)
        for batch in pieces(batches, "text"):
            got = [identifier(t) for t in batch.column(2).to_pylist()]
            lang, value, margin = (list(x) for x in zip(*got, strict=True)) if got else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(value, pa.float64()), pa.array([m < least_margin for m in margin], pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
