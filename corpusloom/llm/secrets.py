"""Operator 5, secret scans: candidates judged by how many owners hold the same value.

Three base kinds are always reported. Besides them, long mixed tokens are candidates: a value that only one
owner holds looks live and is reported, one that several owners hold is an example that was copied around and is not.
The judgement needs the whole corpus: candidate hashes are counted by distinct repository and owner, hash by
owner by repository first, so that a value copied into a third of all documents is counted in parts.

Defined cases: null text is empty; a null owner or repository counts as one owner or repository of its own; repeated rows
each get their own result; an empty table gives an empty result; other columns are not read. Positions are code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, heavy_join, pieces

#: Fixed patterns of the base kinds, in the order of ties.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEAVY, LIGHT = 1000, 1 << 16  # values and span sets of more than a thousandth of all spans, and more than this, are dealt in parts
KINDS = ("assign", "access", "hex", "mixed")
#: The added kind: a token of 24 or more characters with capitals, small letters and digits.
MIXED = re.compile(r"(?a:[A-Za-z0-9+/_-]{24,})")

_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEXES = bytes(104 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_TOKENS = bytes(104 if re.fullmatch(r"(?a:[A-Za-z0-9+/_-])", chr(c)) else 32 for c in range(256))


def scan(text: str) -> list[tuple[int, int, int, str]]:
    """Start, kind, end and value of every span of the base kinds and of every mixed candidate, sorted."""
    data = text.encode("utf-8", "replace")
    low = data.lower()
    found = []
    if any(w in low for w in _WORDS):
        found += [(m.start(), 0, m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if b"AKIA" in data:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if b"h" * 24 in data.translate(_HEXES):
        found += [(m.start(), 2, m.end(), m[0]) for m in re.finditer(r"[0-9a-f]{24,}", text)]
    if b"h" * 24 in data.translate(_TOKENS):
        taken = [(s, e) for s, _, e, _ in found]
        for m in MIXED.finditer(text):
            v = m[0]
            if re.search("[0-9]", v) and re.search("[a-z]", v) and re.search("[A-Z]", v) and not any(s < m.end() and m.start() < e for s, e in taken):
                found.append((m.start(), 3, m.end(), v))
    return sorted(found)


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "little", signed=True)


SPAN = "struct<start:long,kind:int,end:long,value_hash:long>"


def candidates(docs: DataFrame, owner_col: str = "source", repo_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, owner, repo, spans``: one row for each document, its spans with hashes of their values; one narrow pass."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[owner_col].cast("string").alias("owner"), docs[repo_col].cast("string").alias("repo"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value_hash", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            spans = [[{"start": s, "kind": k, "end": e, "value_hash": _hash(v)} for s, k, e, v in scan(t or "")] for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(spans, shape)], ["doc_id", "owner", "repo", "spans"])

    return rows.mapInArrow(run, f"doc_id {kind}, owner string, repo string, spans array<{SPAN}>")


def ownership(found: DataFrame) -> DataFrame:
    """``value_hash, repositories, owners``: in how many distinct repositories and owners each value occurs."""
    each = found.select("owner", "repo", F.explode("spans.value_hash").alias("value_hash"))
    each = each.groupBy("value_hash", "owner", "repo").agg(F.lit(1).alias("one"))
    each = each.groupBy("value_hash", "owner").agg(F.count("*").alias("repos"))
    return each.groupBy("value_hash").agg(F.sum("repos").alias("repositories"), F.count("*").alias("owners"))


def secrets(docs: DataFrame, most_owners: int = 1, owner_col: str = "source", repo_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: each span with kind, start, end, repositories, owners and ``live`` (at most ``most_owners`` hold it).

    Base kinds are all kept; mixed tokens only where they are live. Only documents with spans take part in
    the join on values, and the verdicts return to them by a hash of their spans. In both joins a value or a set of spans that
    very many documents hold is dealt in parts.
    """
    found = cut(candidates(docs, owner_col, repo_col, id_col, text_col))
    some = found.where(F.size("spans") > 0).withColumn("set", F.sha2(F.to_json("spans"), 256))
    most = max(LIGHT, (found.agg(F.sum(F.size("spans"))).first()[0] or 0) // HEAVY)
    parts = some.groupBy("set").agg(F.first("spans").alias("spans")).select("set", F.explode("spans").alias("s")).withColumn("value_hash", F.col("s.value_hash"))
    judged = heavy_join(parts, ownership(found), "value_hash", F.xxhash64("set", "s.start"), most)
    judged = judged.withColumn("live", F.col("owners") <= most_owners)
    judged = judged.where((F.col("s.kind") < 3) | F.col("live"))
    kind = F.array(*map(F.lit, KINDS))[F.col("s.kind")]
    span = F.struct(F.col("s.start").alias("start"), F.col("s.kind").alias("rank"), kind.alias("kind"), F.col("s.end").alias("end"), "repositories", "owners", "live")
    judged = judged.groupBy("set").agg(F.array_sort(F.collect_list(span)).alias("judged"))
    none = F.expr("cast(array() as array<struct<start:long,rank:int,kind:string,end:long,repositories:long,owners:long,live:boolean>>)")
    rest = found.where(F.size("spans") == 0).select("doc_id", none.alias("spans"))
    held = heavy_join(some, judged, "set", F.monotonically_increasing_id(), most, "left")
    return held.select("doc_id", F.coalesce("judged", none).alias("spans")).unionByName(rest)


def digest(found: DataFrame) -> DataFrame:
    """The result of the query: counts, the hash of the base spans and all spans as text."""

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(rank: int):
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    base = F.filter("spans", lambda s: s["rank"] < 3)
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )
