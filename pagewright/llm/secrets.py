"""Secret scan by corpus-wide ownership.

Every candidate's hash is counted by the distinct repositories and owners that hold it. What many owners hold is a
widely copied example; what one owner holds, and looks random, is a live-looking credential.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.base import Kept, released, table, text_slices
from pagewright.llm.spans import SECRET_KINDS, digest, secret_spans, touching

#: The scan's own kinds.
EXTRA = {
    "bearer": re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    "forge": re.compile(r"\bgh[pousr]_[A-Za-z0-9]{30,}+\b"),
    "private": re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    "random": re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+"),
}
#: Owners from which on a candidate counts as an example, and bits a character from which on it looks random.
EXAMPLE_OWNERS, RANDOM_BITS = 3, 3.0
#: Rows of one much-copied candidate are dealt over so many tasks.
SALTS = 16
SCANNED = "row long, doc_id long, owner string, repository string, n_assign long, n_access long, n_hex long, base_sha256 string, found array<struct<kind:string,start:long,end:long,hash:string,bits:double,base:boolean>>"


def bits(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def candidates(text: str) -> list[dict]:
    """Base candidates, and others that touch none of them."""
    base = secret_spans(text) if text else []
    rows = [(k, a, b, v, True) for k, a, b, v in base]
    for kind, pattern in EXTRA.items():
        if kind == "random" and not re.search("[0-9]", text) or kind == "bearer" and "eyJ" not in text or kind == "private" and "-----BEGIN" not in text:
            continue
        taken = touching((a, b) for _, a, b, _, _ in rows)  # matches of one kind never touch each other
        for m in pattern.finditer(text):
            if not taken(*m.span()):
                rows.append((kind, *m.span(), m[0], False))
    rows.sort(key=lambda s: (s[1], SECRET_KINDS.index(s[0]) if s[0] in SECRET_KINDS else 9, s[0]))
    return [{"kind": k, "start": a, "end": b, "hash": hashlib.sha256(v.encode()).hexdigest()[:32], "bits": bits(v), "base": own} for k, a, b, v, own in rows]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.string()), ("bits", pa.float64()), ("base", pa.bool_())]))
    for batch in batches:
        for piece in text_slices(batch):
            found = [candidates(text) for text in piece.column("text").to_pylist()]
            counts = [[sum(c["base"] and c["kind"] == k for c in row) for row in found] for k in SECRET_KINDS]
            digests = [digest([(c["kind"], c["start"], c["end"]) for c in row if c["base"]]) for row in found]
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(c) for c in ("row", "doc_id", "owner", "repository")], *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(found, found_type)],
                names=["row", "doc_id", "owner", "repository", *[f"n_{k}" for k in SECRET_KINDS], "base_sha256", "found"],
            )


def ownership(found: DataFrame) -> DataFrame:
    """Each candidate hash with its distinct repositories and owners; copies within one are dropped before counting."""
    each = found.select("hash", "owner", "repository").groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    owners = each.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return owners.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("copies"))


def find(docs: DataFrame, owner: Column | None = None, repository: Column | None = None) -> DataFrame:
    """A row per document: counts and digest of base spans, all spans, and how many look live or are examples.

    By default a source is an owner, and its documents of one language a repository; a null owner is one owner, ''.
    A null or empty text has no spans; a very long one is read whole. Repeated rows each get a row, a null doc_id stays null, an empty table gives
    no rows; columns that aren't named above aren't read. Added spans are those of the scan's own kinds that look
    live: random, and held by fewer than ``EXAMPLE_OWNERS`` owners. Base spans always stay.
    """
    owner = F.col("source").cast("string") if owner is None else owner
    repository = F.concat_ws("/", F.col("source").cast("string"), F.col("lang").cast("string")) if repository is None else repository
    kept = Kept(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(owner, F.lit("")).alias("owner"), F.coalesce(repository, F.lit("")).alias("repository"), F.col("text").cast("string").alias("text"))
    scanned = kept.write(rows.mapInArrow(released(_scan), SCANNED))
    found = scanned.filter(F.size("found") > 0).select("row", "owner", "repository", F.explode("found").alias("c")).select("row", "owner", "repository", "c.*")
    verdict = kept.write(ownership(found))
    dealt = verdict.select("hash", (F.col("owners") >= EXAMPLE_OWNERS).alias("example"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    judged = found.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(dealt.hint("merge"), ["hash", "salt"])
    order = F.when(F.col("kind") == "assign", 0).when(F.col("kind") == "access", 1).when(F.col("kind") == "hex", 2).otherwise(3)
    live = ~F.col("example") & (F.col("bits") >= RANDOM_BITS)
    by_row = judged.filter("base OR (NOT example AND bits >= {bits})".format(bits=RANDOM_BITS)).withColumn("live", live).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", order.alias("o"), "kind", "end"))).alias("s"),
        F.count_if("live").alias("n_live"),
        F.count_if(F.col("example")).alias("n_example"),
    )
    spans = F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    fixed = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    with_found = scanned.filter(F.size("found") > 0).select("row", *fixed).join(by_row, "row", "left").select(*fixed, F.coalesce(spans, F.lit("")).alias("spans"), F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"))
    none = F.lit(0).cast("long")
    return with_found.unionByName(scanned.filter(F.size("found") == 0).select(*fixed, F.lit("").alias("spans"), none.alias("n_live"), none.alias("n_example")))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
