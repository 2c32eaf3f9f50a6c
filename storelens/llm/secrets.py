"""Secret scan with corpus-wide ownership of every candidate.

Each text is searched for candidates.  Three base kinds are always reported;
other kinds are only candidates, since their patterns also meet harmless text.
The hash of every candidate's value is counted over the corpus by distinct
repositories and owners.  A value with many owners is a copied example, one that
a single owner has in few repositories looks live.  Candidates of the other kinds are reported
if they look live.

Edge cases: a null or empty text has no spans.  A null owner or repository is
one of its own.  Repeated rows each get their spans and count once for their
repository.  Spans count code points, their end is exclusive; spans of different
kinds may overlap and are ordered by start, then kind.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import checked_join, stored

BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("provider", "jwt", "opaque")
KINDS = BASE_KINDS + ADDED_KINDS

EXAMPLE_OWNERS = 3
LIVE_REPOSITORIES = 3

# The base patterns and the least length of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX = re.compile(r"[0-9a-f]{16,}")

# Added candidates: keys with a provider's mark, signed tokens, long strings of mixed characters.
PROVIDER = re.compile(r"(?:gh[opsu]_|github_pat_|glpat-|xox[abprs]-|sk_live_|rk_live_|AIza|npm_)[A-Za-z0-9_-]{16,}")
PROVIDER_MARKS = ("gho_", "ghp_", "ghs_", "ghu_", "github_pat_", "glpat-", "xox", "_live_", "AIza", "npm_")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{24,}")
OPAQUE_LEAST_EACH = 2

_SCAN = (
    "struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base_sha256:string,"
    "found:array<struct<kind:string,start:bigint,end:bigint,value:string>>>"
)


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, secret value) of every candidate, by start, then kind."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        found += [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    if any(mark in text for mark in PROVIDER_MARKS):
        found += [("provider", *m.span(), m[0]) for m in PROVIDER.finditer(text)]
    if "eyJ" in text:
        found += [("jwt", *m.span(), m[0]) for m in JWT.finditer(text)]
    found += [("opaque", *m.span(), m[0]) for m in OPAQUE.finditer(text) if _mixed(m[0])]
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def _mixed(value: str) -> bool:
    classes = (sum(map(str.isdigit, value)), sum(map(str.isupper, value)), sum(map(str.islower, value)))
    return min(classes) >= OPAQUE_LEAST_EACH


def _listed(spans: list[tuple[str, int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in spans)


def _row(text: str | None) -> dict:
    found = candidates(text) if text else []
    base = [span for span in found if span[0] in BASE_KINDS]
    counts = {f"n_{kind}": sum(span[0] == kind for span in base) for kind in BASE_KINDS}
    return counts | {
        "base_sha256": hashlib.sha256(_listed(base).encode()).hexdigest(),
        "found": [
            {"kind": kind, "start": start, "end": end, "value": hashlib.sha256(value.encode()).hexdigest()[:32]}
            for kind, start, end, value in found
        ],
    }


_FOUND = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
_ROW = pa.struct(
    [(f"n_{kind}", pa.int64()) for kind in BASE_KINDS] + [("base_sha256", pa.string()), ("found", pa.list_(_FOUND))]
)


def scan(text: Column) -> Column:
    """Candidates of each text as one struct."""

    @F.arrow_udf(_SCAN)
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_row(value.as_py()) for value in batch], _ROW)

    return scanned(text)


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners and repositories of every value; ``found`` has value, owner, repository.

    Copies of a value within a repository are merged before they are moved, so that
    a value in a third of all texts is no more than a row per task.
    """
    per_repository = found.groupBy("value", "owner", "repository").agg(F.count(F.lit(1)).alias("seen"))
    per_owner = per_repository.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("seen").alias("seen"))
    return per_owner.groupBy("value").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("repositories").alias("n_repositories"), F.sum("seen").alias("n_seen")
    )


def verdict(
    n_owners: Column, n_repositories: Column, *, example_owners: int = EXAMPLE_OWNERS, live_repositories: int = LIVE_REPOSITORIES
) -> Column:
    """``example`` with many owners, ``live`` with one and few repositories, else ``shared``."""
    live = (n_owners == 1) & (n_repositories <= live_repositories)
    return F.when(n_owners >= example_owners, "example").when(live, "live").otherwise("shared")


def find_secrets(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", owner: Column | None = None, repository: Column | None = None
) -> DataFrame:
    """One row per document: its key, text_hash and text_check, base counts, base_sha256, spans, n_live, n_example.

    ``owner`` and ``repository`` default to the columns source and (source, lang).
    The result holds no text: the scan is stored without it and joined with the ownership counts.
    """
    owner = F.col("source").cast("string") if owner is None else owner
    repository = F.to_json(F.struct("source", "lang")) if repository is None else repository
    body = F.col(f"`{text}`")
    scanned = docs.select(
        F.col(f"`{key}`").alias(key), *_identity(F.col(f"`{key}`"), body), owner.alias("owner"), repository.alias("repository"),
        scan(body).alias("scan"),
    )
    identity = ("text_hash", "text_check")
    rows = stored(scanned.select(F.monotonically_increasing_id().alias("row"), key, *identity, "owner", "repository", "scan.*"), "secret-scan")
    spans = rows.select("row", "owner", "repository", F.inline("found"))
    owners = stored(ownership(spans), "secret-owners")
    judged = checked_join(spans, owners, "value", "left").withColumn("verdict", verdict(F.col("n_owners"), F.col("n_repositories")))
    kept = judged.where(F.col("kind").isin(*BASE_KINDS) | (F.col("verdict") == "live"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    entry = F.struct("start", rank.alias("rank"), "end", "kind")
    lists = kept.groupBy("row").agg(
        F.sort_array(F.collect_list(entry)).alias("entries"),
        F.count_if(F.col("verdict") == "live").alias("n_live"),
        F.count_if(F.col("verdict") == "example").alias("n_example"),
    )
    listed = F.transform("entries", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    texts = lists.select("row", F.array_join(listed, ",").alias("spans"), "n_live", "n_example")
    joined = rows.join(texts, "row", "left")
    return joined.select(
        key, *identity, *[f"n_{kind}" for kind in BASE_KINDS], "base_sha256", F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"), F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"),
    )


def _identity(key: Column, text: Column) -> tuple[Column, Column]:
    """Two numbers that stand for a document's key and text; nulls have theirs, too."""
    return F.xxhash64(key, text).alias("text_hash"), F.hash(text).alias("text_check")


def _redacted(text: str, spans: str) -> str:
    parts, at = [], 0
    for span in spans.split(","):
        kind, start, end = span.split(":")
        begin, stop = int(start), int(end)
        if begin >= at:
            parts += [text[at:begin], f"[{kind} removed]"]
        at = max(at, stop)
    return "".join([*parts, text[at:]])


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind; overlapping spans become one."""

    @F.arrow_udf("string")
    def redacted(texts: pa.Array, lists: pa.Array) -> pa.Array:
        pairs = zip(texts.to_pylist(), lists.to_pylist(), strict=True)
        return pa.array([_redacted(t, s) if t and s else t for t, s in pairs], pa.string())

    return redacted(text, spans)


def redact_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """Documents with their reported secrets replaced; the length column follows where a text changes.

    Rows are matched by key and text, so repeated keys with other texts keep apart.
    """
    found = find_secrets(docs, key=key, text=text).where(F.col("spans") != "")
    changes = stored(found.select("text_hash", "text_check", "spans").distinct(), "secret-spans")
    # The documents' own columns are held in one, so that no name of theirs meets one from here.
    body = F.col(f"`{text}`")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), body.alias("body"), *_identity(F.col(f"`{key}`"), body))
    marked = checked_join(rows, changes, ["text_hash", "text_check"], "left")
    same = marked.where(F.col("spans").isNull()).select("row.*")
    changed = marked.where(F.col("spans").isNotNull()).select("row", redact(F.col("body"), F.col("spans")).alias("body"))
    new = {text: F.col("body")}
    if length in docs.columns:
        new[length] = F.length("body").cast(docs.schema[length].dataType)
    return same.unionAll(changed.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]))
