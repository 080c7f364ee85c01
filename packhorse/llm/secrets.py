"""Operator 3: secret scan with corpus-wide ownership frequency.

Candidates are found by pattern in whole texts. How many repositories and
owners hold a candidate's value tells examples that everybody copies from
credentials of one owner. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packhorse.llm.common import stored, table


@dataclass(frozen=True)
class Kind:
    """`pattern` finds candidates; `least` is the least length of group `group`.

    `anchors` are strings of which one is in every text with a match.
    """

    name: str
    pattern: str
    group: int = 0
    least: int = 0
    anchors: tuple[str, ...] = ()


# The base patterns, in the order in which their spans are listed.
BASE = (
    Kind("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 20, ("AKIA",)),
    Kind("hex", r"[0-9a-f]{24,}", 0, 24),
)
# What the operator adds. Their spans are reported where they look live.
MORE = (
    Kind("github", r"(?:gh[pousr]_|github_pat_)[A-Za-z0-9_]{36,}", anchors=("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_")),
    Kind("slack", r"xox[abeprs]-[A-Za-z0-9-]{10,}", anchors=("xox",)),
    Kind("google", r"AIza[A-Za-z0-9_-]{35}", anchors=("AIza",)),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", anchors=("eyJ",)),
    Kind("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]+(?:-{1,4}[^-]+){0,64}-----END [A-Z ]*PRIVATE KEY-----", anchors=("PRIVATE KEY-----",)),
    Kind("url", r"://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/@]+@", anchors=("://",)),
)
KINDS = BASE + MORE
# Kinds whose values people make up; elsewhere such a word may stand in the code by chance.
WORDED = ("assign", "access", "hex", "url")
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your|xxxx|1234567|abcdef0"


@dataclass(frozen=True)
class Settings:
    """A value held by `copied_owners` owners or more is an example that is copied.

    So is one that more than one owner has, in `shared_repositories` or more. What a
    single owner has may be live in any number of its repositories, unless
    `copied_repositories` is given: that many make an example whoever owns them. It
    is for tables whose owner is coarse, but also takes a credential that
    one owner has in that many repositories, or that copies of one text hold, for an example.
    """

    copied_owners: int = 3
    shared_repositories: int = 20
    copied_repositories: int | None = None
    least_distinct: int = 8


def _candidates(text: Column, rank: int, kind: Kind) -> Column:
    """Array of (rank, characters since the last match, match), empty without a match.

    Cutting at a pattern and listing its matches take the same matches in the
    same order, so their lengths give every position.
    """
    gaps = F.transform(F.split(text, kind.pattern, -1), lambda piece: F.length(piece).cast("long"))
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    found = F.zip_with(
        F.slice(gaps, 1, F.size(hits)), hits,
        lambda gap, hit: F.struct(F.lit(rank).alias("rank"), gap.alias("gap"), hit.alias("hit")),
    )
    seen = text.rlike(kind.pattern)
    if kind.anchors:
        seen = reduce(or_, (text.contains(anchor) for anchor in kind.anchors)) & seen
    return F.when(seen, found)


def _value() -> Column:
    """What is secret in a match: for assignments the assigned value."""
    value = F.col("hit")
    for rank, kind in enumerate(KINDS):
        if kind.group:
            value = F.when(F.col("rank") == rank, F.regexp_extract("hit", kind.pattern, kind.group)).otherwise(value)
    return value


def _long_enough() -> Column:
    ok = F.lit(True)
    for rank, kind in enumerate(KINDS):
        if kind.least:
            ok = ok & ((F.col("rank") != rank) | (F.length("value") >= kind.least))
    return ok


def looks_live(value: Column, rank: Column, settings: Settings) -> Column:
    distinct = F.size(F.array_distinct(F.split(value, "")))
    worded = rank.isin([at for at, kind in enumerate(KINDS) if kind.name in WORDED])
    return value.rlike("[0-9]") & ~(worded & value.rlike(PLACEHOLDER)) & (distinct >= settings.least_distinct)


def ownership(spans: DataFrame, settings: Settings) -> DataFrame:
    """Per value hash the numbers of owners and repositories, and the verdict.

    Counted in two steps that first merge, in the map tasks, what one owner or
    repository repeats, so a value that is everywhere costs one task no more
    than its owners. A null owner or repository is one like any other.
    """
    per_repository = spans.groupBy("hash", "owner", "repository").agg(F.max("live").alias("live"))
    per_owner = per_repository.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"), F.max("live").alias("live"))
    counted = per_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"), F.max("live").alias("live")
    )
    copied = (F.col("n_owners") >= settings.copied_owners) | (
        (F.col("n_owners") > 1) & (F.col("n_repositories") >= settings.shared_repositories)
    )
    if settings.copied_repositories is not None:
        copied = copied | (F.col("n_repositories") >= settings.copied_repositories)
    verdict = (
        F.when(copied, "copied")
        .when(F.col("live"), "live").otherwise("unclear")
    )
    return counted.select("hash", "n_owners", "n_repositories", verdict.alias("verdict"), F.col("live").alias("looks_live"))


def find_secrets(
    df: DataFrame,
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    out: str = "secrets",
    keep_text: bool = True,
    settings: Settings | None = None,
    copied_too: bool = False,
) -> DataFrame:
    """`df` with an array `out` of spans, by start and kind.

    A span has kind, start and end (code points, end exclusive), base, the
    verdict (live, copied, unclear), n_owners and n_repositories. Base spans are always there;
    others where their verdict is live, or, with `copied_too`, where they look live
    however many have them, as what is to be removed must be found. Null text counts as empty and has no
    spans; repeated rows get the same spans each; an empty table gives an empty
    one; a column that is already named `out` is replaced, and names that begin
    with `_scan` are reserved. The table is stored once in the scratch folder.
    """
    settings = settings or Settings()
    whole = F.coalesce(F.col(text), F.lit(""))
    found = F.filter(F.array(*(_candidates(whole, rank, kind) for rank, kind in enumerate(KINDS))), F.isnotnull)
    kept = [F.col(name) for name in df.columns if name != out and (keep_text or name != text)]
    scanned = df.select(
        *kept, F.monotonically_increasing_id().alias("_scan_row"),
        F.col(owner).cast("string").alias("_scan_owner"), F.col(repository).cast("string").alias("_scan_repository"),
        F.flatten(found).alias("_scan_hits"),
    )
    rows = stored(scanned, "secrets")
    some = F.size("_scan_hits") > 0
    order = Window.partitionBy("_scan_row", "rank").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.filter(some)
        .select("_scan_row", F.col("_scan_owner").alias("owner"), F.col("_scan_repository").alias("repository"), F.posexplode("_scan_hits").alias("pos", "one"))
        .select("_scan_row", "owner", "repository", "pos", "one.*")
        .withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(order))
        .withColumn("start", F.col("end") - F.length("hit"))
        .withColumn("value", _value())
        .filter(_long_enough())
        .select(
            "_scan_row", "owner", "repository", "rank", "start", "end",
            F.sha2("value", 256).alias("hash"), looks_live(F.col("value"), F.col("rank"), settings).alias("live"),
        )
    )
    spans = stored(placed, "secret-spans")
    names = F.array(*(F.lit(kind.name) for kind in KINDS))
    judged = spans.join(ownership(spans, settings), "hash").filter(
        (F.col("rank") < len(BASE)) | (F.col("looks_live") if copied_too else F.col("verdict") == "live")
    )
    one = F.struct(
        "start", "rank", "end", F.element_at(names, F.col("rank") + 1).alias("kind"),
        (F.col("rank") < len(BASE)).alias("base"), "verdict", "n_owners", "n_repositories",
    )
    listed = judged.groupBy("_scan_row").agg(F.sort_array(F.collect_list(one)).alias(out))
    none = F.lit(None).cast(listed.schema[out].dataType)
    marked = rows.filter(some).join(listed, "_scan_row", "left").unionByName(
        rows.filter(~some).withColumn(out, none)
    )
    empty = F.array().cast(listed.schema[out].dataType)
    columns = [name for name in df.columns if keep_text or name != text]
    columns += [] if out in columns else [out]
    return marked.withColumn(out, F.coalesce(out, empty)).select(*columns)


def redact(df: DataFrame, text: str = "text", spans: str = "secrets", mark: str = "[SECRET]") -> DataFrame:
    """`df` with every span of `spans` in `text` replaced; spans that touch or overlap become one mark.

    Rows without spans, a null text or null spans among them, stay as they are, as
    do all other columns, whatever their names, and repeated rows. Long texts are
    cut whole; an empty table gives an empty one.
    """
    start = F.struct(F.lit(0).cast("long").alias("end"), F.array().cast("array<string>").alias("parts"))

    def cut(done: Column, span: Column) -> Column:
        gap = F.substring(F.col(text), (done["end"] + 1).cast("int"), (span["start"] - done["end"]).cast("int"))
        new = span["start"] > done["end"]
        first = F.size(done["parts"]) == 0
        parts = F.when(new | first, F.concat(done["parts"], F.array(gap, F.lit(mark)))).otherwise(done["parts"])
        return F.struct(F.greatest(done["end"], span["end"]).alias("end"), parts.alias("parts"))

    def close(done: Column) -> Column:
        rest = F.substring(F.col(text), (done["end"] + 1).cast("int"), F.length(F.col(text)))
        return F.concat(F.array_join(done["parts"], ""), rest)

    return df.withColumn(text, F.when(F.size(spans) > 0, F.aggregate(spans, start, cut, close)).otherwise(F.col(text)))


def _joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have one column of provenance: `source` is the owner, a document the repository."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = find_secrets(docs, keep_text=False)
    spans = F.col("secrets")

    def number(of: Column, value: object) -> Column:
        return F.size(F.filter(spans, lambda s: s[of] == value)).cast("long")

    return found.select(
        "doc_id", *(number("kind", kind.name).alias(f"n_{kind.name}") for kind in BASE),
        F.sha2(_joined(F.filter(spans, lambda s: s["base"])), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        number("verdict", "live").alias("n_live"), number("verdict", "copied").alias("n_copied"),
    )


def _oracle(settings: Settings) -> str:
    def either(word: str) -> str:
        return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)

    words = "|".join(either(word) for word in ("password", "passwd", "secret", "token", "api_?key"))
    scans = []
    for rank, kind in enumerate(KINDS):
        pattern = kind.pattern
        if kind.name == "assign":
            pattern = "(?:" + words + ")" + pattern[pattern.index(")") + 1 :]
        quoted = pattern.replace("'", "''")
        value = f"regexp_extract(hit, '^{quoted}$', {kind.group})" if kind.group else "hit"
        scans.append(
            f"""SELECT r, doc_id, source, {rank} AS rank, '{kind.name}' AS kind, e - length(hit) AS s, e, {value} AS value, {kind.least} AS least
            FROM (SELECT r, doc_id, source, hit,
                    sum(length(gap) + length(hit)) OVER (PARTITION BY r ORDER BY i) AS e
                  FROM (SELECT r, doc_id, source, unnest(gaps[1:len(hits)]) AS gap, unnest(hits) AS hit, unnest(range(len(hits))) AS i
                        FROM (SELECT *, regexp_split_to_array(t, '{quoted}') AS gaps, regexp_extract_all(t, '{quoted}') AS hits FROM d)))"""
        )
    every = "\n            UNION ALL ".join(scans)
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
        found AS (SELECT * FROM ({every}) WHERE length(value) >= least),
        judged AS (
            SELECT value, count(DISTINCT coalesce(source, chr(1))) AS owners,
                count(DISTINCT (coalesce(source, chr(1)), coalesce(doc_id, -1))) AS repositories,
                regexp_matches(value, '[0-9]') AND bool_or(kind NOT IN {WORDED} OR NOT regexp_matches(value, '{PLACEHOLDER}'))
                AND len(list_distinct(string_split(value, ''))) >= {settings.least_distinct} AS live
            FROM found GROUP BY value),
        spans AS (
            SELECT r, rank, kind, s, e,
                CASE WHEN owners >= {settings.copied_owners} OR (owners > 1 AND repositories >= {settings.shared_repositories}) THEN 'copied' WHEN live THEN 'live' ELSE 'unclear' END AS verdict
            FROM found JOIN judged USING (value)),
        listed AS (
            SELECT r, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k, count(*) FILTER (kind = 'hex') AS h,
                string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < {len(BASE)}) AS base,
                string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans,
                count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'copied') AS n_copied
            FROM spans WHERE rank < {len(BASE)} OR verdict = 'live' GROUP BY r)
        SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
            sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
            coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
        FROM d LEFT JOIN listed USING (r)"""


QUERIES = {"op3_secrets": op3_secrets}
ORACLES = {"op3_secrets": _oracle(Settings())}
