"""Secret scan with corpus-wide ownership frequency.

Every text is searched for candidates of several kinds. Candidates are hashed, and for each hash the distinct
texts, repositories and owners that hold it are counted over the whole corpus. A text counts once, with one owner and repository (the
smallest), however often it was copied: a live key in a document that others copied stays its owner's. A string that
``EXAMPLE_OWNERS`` owners and ``EXAMPLE_REPOSITORIES`` repositories hold in texts of their own is a widely copied example
(documentation keys, test vectors); any other looks like a live credential of its owner.

Base kinds (``assign``, ``access``, ``hex``) are always reported. The kind ``owned`` is found by the method alone:
an unbroken run of 24 or more credential characters with letters of both cases and digits, without a match of a base kind in it.
So the method only adds spans, and drops none: each is listed with its class and counts.

The scan emits candidates only (document, kind, span, 128-bit hashes of string and text). Repeated (string, text) pairs collapse
map-side before they are counted, and the counts return by a join salted by document, so one example key in a third
of all documents is neither one task's work nor one row's.

Null text is empty: no candidates. Null repository or owner is a value of its own. Repeated rows are scanned each; their text
counts once. Rows are told apart by an id given in the scan, so repeated or null doc_ids keep their own
spans. An empty table gives an empty result. Very long texts need memory in proportion to the text. Further columns
play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_batches, own_worker, salted_join, stored

KINDS = ("assign", "access", "hex", "owned")
#: Owners and repositories, each with a text of its own, from which a string counts as a widely copied example.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 3

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
#: Runs in which all access, hex and owned candidates lie whole: 20 characters of their joint alphabet.
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_CASES = re.compile(r"(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])", re.DOTALL)
OWNED_LENGTH = 24


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind index, end, secret) of one text, by start, then kind; the secret of an assignment is its value."""
    found: list[tuple[int, int, int, str]] = []
    folded = text.lower()  # only to see whether a keyword can be there
    if any(word in folded for word in ("password", "passwd", "secret", "token", "api")):
        found += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    values = [(end - len(secret), end) for _, _, end, secret in found]
    for run in _RUN.finditer(text):
        at, body = run.start(), run[0]
        base = [(at + m.start(), 1, at + m.end(), m[0]) for m in _ACCESS.finditer(body) if len(m[0]) >= 20]
        base += [(at + m.start(), 2, at + m.end(), m[0]) for m in _HEX.finditer(body) if len(m[0]) >= 24]
        found += base
        if not base and len(body) >= OWNED_LENGTH and _CASES.match(body) and not any(s < run.end() and at < e for s, e in values):
            found.append((at, 3, run.end(), body))
    return sorted(found)


_SCAN = "row_id long, doc_id {id}, n_assign long, n_access long, n_hex long, base_sha256 string, owner string, repository string, text_id binary, found array<struct<kind:int,start:int,end:int,secret:binary>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own_worker("secret_scan")
    row = TaskContext.get().partitionId() << 33
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("secret", pa.binary())]))
    for batch in batches:
        ids, counts, digests, texts, found = [], ([], [], []), [], [], []
        for text in batch.column(3):
            body = text.as_py()
            got = candidates(body)
            texts.append(hashlib.sha256(body.encode()).digest()[:16] if got else None)
            for k in range(3):
                counts[k].append(sum(c[1] == k for c in got))
            spans = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in got if k < 3)
            digests.append(hashlib.sha256(spans.encode()).hexdigest())
            found.append([{"kind": k, "start": s, "end": e, "secret": hashlib.sha256(x.encode()).digest()[:16]} for s, k, e, x in got])
            ids.append(row)
            row += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()),
             batch.column(1), batch.column(2), pa.array(texts, pa.binary()), pa.array(found, kind)],
            ["row_id", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "owner", "repository", "text_id", "found"])


def scan(docs: DataFrame, repository_cols: tuple[str, ...], owner_cols: tuple[str, ...], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row its candidates, stored: the row ids stay as they are."""
    joined = lambda cols: F.to_json(F.array(*[F.col(f"`{c}`").cast("string") for c in cols]))  # noqa: E731  null differs from any text
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), joined(owner_cols).alias("owner"), joined(repository_cols).alias("repository"),
                         F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return stored(map_batches(source, _scan, _SCAN.format(id=source.schema["doc_id"].dataType.simpleString())), "secrets")


def ownership(found: DataFrame) -> DataFrame:
    """(secret, n_texts, n_repositories, n_owners) per hash, from rows (secret, text_id, repository, owner): each text counts once, with its smallest owner and repository."""
    texts = found.groupBy("secret", "text_id").agg(F.min("repository").alias("repository"), F.min("owner").alias("owner"))
    return texts.groupBy("secret").agg(F.count("*").alias("n_texts"), F.countDistinct("repository").alias("n_repositories"), F.countDistinct("owner").alias("n_owners"))


def report(docs: DataFrame, repository_cols: tuple[str, ...], owner_cols: tuple[str, ...], text_col: str = "text", id_col: str = "doc_id",
           example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, owned_spans, example_spans, n_owned, n_examples, most_owners, most_repositories, ownership.

    ``example_spans`` are the spans of strings with at least ``example_owners`` owners and ``example_repositories`` repositories, ``owned_spans`` the
    rest. ``ownership`` lists each span's texts, owners and repositories (``span=texts/owners/repositories``), joined like the spans.
    """
    rows = scan(docs, repository_cols, owner_cols, text_col, id_col)
    each = rows.where(F.size("found") > 0).select("row_id", "owner", "repository", "text_id", F.explode("found").alias("f")).select("row_id", "owner", "repository", "text_id", "f.*")
    judged = salted_join(each, ownership(each), ["secret"], "row_id")
    example = (F.col("n_owners") >= example_owners) & (F.col("n_repositories") >= example_repositories)
    span = F.concat_ws(":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1), F.col("start"), F.col("end"))
    listed = judged.groupBy("row_id").agg(  # as many as the one document holds
        F.sort_array(F.collect_list(F.struct("start", "kind", span.alias("span"), example.alias("example"), F.concat_ws("/", "n_texts", "n_owners", "n_repositories").alias("held")))).alias("list"),
        F.count(F.when(~example, 1)).alias("n_owned"), F.count(F.when(example, 1)).alias("n_examples"), F.max("n_owners").alias("most_owners"), F.max("n_repositories").alias("most_repositories"))
    text = lambda keep: F.coalesce(F.array_join(F.transform(F.filter("list", keep), lambda x: x["span"]), ","), F.lit(""))
    out = rows.drop("found", "owner", "repository", "text_id").join(listed, "row_id", "left")
    return out.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        text(lambda x: F.lit(True)).alias("spans"),
        text(lambda x: ~x["example"]).alias("owned_spans"),
        text(lambda x: x["example"]).alias("example_spans"),
        *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("n_owned", "n_examples", "most_owners", "most_repositories")],
        F.coalesce(F.array_join(F.transform("list", lambda x: F.concat_ws("=", x["span"], x["held"])), ","), F.lit("")).alias("ownership"),
    )
