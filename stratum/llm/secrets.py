"""Secret scans by corpus-wide ownership frequency (DataFrame functions only).

Spans are found per document with regular expressions. Every found value is hashed, and the hashes are counted over
the whole corpus by distinct repositories and distinct owners: a value that many owners carry is a copied example,
a value that few owners carry and that looks random is a live credential of its owner. A value known from a
keyword or key pattern anywhere in the corpus is then also reported where it stands bare (kind ``known``).

Positions are code points, ends exclusive. A null text counts as empty, a null owner or repository as one unnamed
owner or repository; repeated rows are separate rows of the result but one repository; an empty table gives an empty
result. Columns of the caller other than the named ones are not read, so their names cannot clash.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import cut, text_or_empty

ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
HEX_RUN = r"[0-9a-f]{24,}"          # the runs of HEX that are long enough: the same spans, fewer matches
ACCESS_RUN = r"AKIA[A-Z0-9]{16,}"   # likewise: a key that is too short holds no longer one
RUN = r"[A-Za-z0-9+/_=-]{16,}"      # a bare value, for kind ``known``
KINDS = ["assign", "access", "hex", "known"]
PLACEHOLDER = r"(?i)example|sample|changeme|change_me|dummy|placeholder|your[_-]|xxxx|1234567|abcdef"

SPAN = "struct<start:bigint,kind:int,end:bigint,sha:string,live:boolean>"


def _spans(text: Column, pattern: str, kind: int, value_group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as sorted structs: the text between two matches (``split``) and the matches
    themselves (``regexp_extract_all``) give the positions by adding up their lengths."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else whole
    pieces = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole)).alias("gap"),
                          whole.alias("whole"), value.alias("value"))
    none = F.array().cast(f"array<{SPAN}>")

    def step(acc: Column, piece: Column) -> Column:
        start = acc["at"] + F.length(piece["gap"])
        end = start + F.length(piece["whole"])
        v = piece["value"]
        live = ((F.size(F.array_distinct(F.split(v, ""))) >= 8) & v.rlike("[0-9]") & ~v.rlike(PLACEHOLDER))
        span = F.struct(start.cast("bigint").alias("start"), F.lit(kind).alias("kind"), end.cast("bigint").alias("end"),
                        F.sha2(v, 256).alias("sha"), live.alias("live")).cast(SPAN)
        return F.struct(end.cast("bigint").alias("at"),
                        F.when(F.length(v) >= least, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(pieces, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out")), step,
                        lambda acc: acc["out"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def scan(documents: DataFrame, text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id",
         keep: list[str] = ()) -> DataFrame:
    """One row per input row: ``keep`` columns, ``owner``, ``repo``, ``base`` (spans of the three patterns, sorted)
    and ``runs`` (bare values that look random and lie in no base span)."""
    text = F.col("__text")
    df = documents.select(*[F.col(c).alias(f"k_{c}") for c in keep], text_or_empty(text_col).alias("__text"),
                          F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
                          F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"))
    base = F.array_sort(F.concat(_spans(text, ASSIGN, 0, 2, 6), _spans(text, ACCESS_RUN, 1), _spans(text, HEX_RUN, 2)))
    df = df.withColumn("base", base).withColumn("runs", _spans(text, RUN, 3))
    free = F.filter("runs", lambda r: r["live"] & ~F.exists(
        "base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return df.withColumn("runs", free)


def ownership(candidates: DataFrame) -> DataFrame:
    """(sha, n_repos, n_owners, n_uses) over rows (sha, owner, repo). Counted in three steps, each on a finer key
    first, so that a value copied into a third of all documents is pre-aggregated before every shuffle."""
    per_repo = candidates.groupBy("sha", "owner", "repo").agg(F.count(F.lit(1)).alias("uses"))
    per_owner = per_repo.groupBy("sha", "owner").agg(F.sum("uses").alias("uses"),
                                                     F.count(F.lit(1)).alias("repos"))
    return per_owner.groupBy("sha").agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"),
                                        F.sum("uses").alias("n_uses"))


def find_secrets(documents: DataFrame, text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id",
                 keep: list[str] = ("doc_id",), min_owners: int = 5, with_text: bool = False
                 ) -> tuple[DataFrame, DataFrame]:
    """(rows, spans) of the scan.

    ``rows``: one row per input row that matters (``uid``, ``k_<keep>``, ``base``, and the text if ``with_text``).
    ``spans``: one row per span: uid, k_<keep>, start, end, kind, sha256 of the value, n_repos, n_owners, n_uses and
    ``verdict``: ``copied`` (at least ``min_owners`` owners carry the value), ``live`` (fewer owners, and the value
    looks random) or ``weak``.
    """
    rows = scan(documents, text_col, owner_col, repo_col, list(keep))
    if with_text:
        rows = rows.where((F.size("base") > 0) | (F.size("runs") > 0)).withColumnRenamed("__text", "text")
    else:
        rows = rows.drop("__text")
    rows = cut(rows.withColumn("uid", F.monotonically_increasing_id()), "secrets-rows")
    kept = [c for c in rows.columns if c.startswith("k_")]
    base = rows.where(F.size("base") > 0).select("uid", *kept, "owner", "repo", F.inline("base"))
    runs = rows.where(F.size("runs") > 0).select("uid", *kept, "owner", "repo", F.inline("runs"))
    named = cut(base.groupBy("sha").agg(F.max("live").alias("live")).where("live").select("sha"), "secrets-named")
    spans = cut(base.unionByName(runs.join(named, "sha", "left_semi").select(*base.columns)), "secrets-spans")
    counts = cut(ownership(spans), "secrets-counts")
    verdict = (F.when(F.col("n_owners") >= min_owners, "copied").when(F.col("live"), "live").otherwise("weak"))
    # both sides come from written tables: a value with a third of all rows is split by the adaptive skew join
    return rows, (spans.join(counts, "sha").withColumn("verdict", verdict)
                  .withColumn("kind_name", F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
           min_owners: int = 5) -> DataFrame:
    """One row per input row: counts per base kind, sha256 of the listed base spans, all spans, and how many of them
    are copied examples or live."""
    rows, spans = find_secrets(documents, text_col, owner_col, id_col, [id_col], min_owners)
    per_row = spans.groupBy("uid").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("all"),
        F.sum(F.when(F.col("verdict") == "copied", 1).otherwise(0)).alias("n_copied"),
        F.sum(F.when(F.col("verdict") == "live", 1).otherwise(0)).alias("n_live"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return (rows.join(per_row, "uid", "left").select(
        F.col(f"k_{id_col}").alias(id_col), count(0).alias("n_assign"), count(1).alias("n_access"),
        count(2).alias("n_hex"), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        F.coalesce(_listed(F.col("all")), F.lit("")).alias("spans"),
        F.coalesce("n_copied", F.lit(0)).cast("bigint").alias("n_copied"),
        F.coalesce("n_live", F.lit(0)).cast("bigint").alias("n_live")))


def redact(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
           min_owners: int = 5, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span but those of copied examples replaced by ``mark``; overlapping spans become one
    mark. All rows and columns are kept; ``n_chars`` (if present) follows the text. Rows without a span are passed
    through as they are."""
    columns = documents.columns
    rows, spans = find_secrets(documents, text_col, owner_col, id_col, columns, min_owners, with_text=True)
    out = spans.where(F.col("verdict") != "copied").groupBy("uid").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("out"))
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(
            acc["done"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
            F.lit(mark))).otherwise(acc["done"]).alias("done"))

    # everything after the last span: substring with a length beyond the end keeps the rest
    clean = F.aggregate("out", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("done")), step,
                        lambda a: F.concat(a["done"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    hit = rows.join(out, "uid", "left").withColumn(
        "clean", F.when(F.col("out").isNull(), F.col(f"k_{text_col}")).otherwise(clean))
    new = {text_col: F.col("clean")}
    if "n_chars" in columns and "n_chars" != text_col:
        new["n_chars"] = F.when(F.col("out").isNull(), F.col("k_n_chars")).otherwise(
            F.length("clean")).cast(documents.schema["n_chars"].dataType)
    hit = hit.select(*[new.get(c, F.col(f"k_{c}")).alias(c) for c in columns])
    seen = scan(documents, text_col, owner_col, id_col, columns)
    rest = seen.where((F.size("base") == 0) & (F.size("runs") == 0)).select(
        *[F.col(f"k_{c}").alias(c) for c in columns])
    return rest.unionByName(hit)


_ORACLE_ASSIGN = ("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
                  "[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)")


def _oracle_kind(no: int, pattern: str, group: int, least: int) -> str:
    return f"""SELECT rid, {no} AS kind, a AS s, a + length(w) AS e, sha256(v) AS sha, v FROM (
      SELECT rid, unnest(list_transform(range(1, len(ms) + 1), lambda i: {{'w': ms[i], 'v': vs[i],
        'a': list_sum(list_transform(gs[1:i], lambda x: length(x))) +
             coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0)}}), recursive := true)
      FROM (SELECT rid, regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {group}) AS vs,
            string_split_regex(t, '{pattern}') AS gs FROM d WHERE regexp_matches(t, '{pattern}')))
      WHERE length(v) >= {least}"""


#: The same rows in DuckDB (documents with one row per doc_id).
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id AS rid, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents),
found AS ({_oracle_kind(0, _ORACLE_ASSIGN, 2, 6)} UNION ALL {_oracle_kind(1, ACCESS, 0, 20)}
          UNION ALL {_oracle_kind(2, HEX_RUN, 0, 24)}),
base AS (SELECT *, len(list_distinct(string_split(v, ''))) >= 8 AND regexp_matches(v, '[0-9]')
         AND NOT regexp_matches(v, '{PLACEHOLDER}') AS live FROM found),
runs AS (SELECT *, len(list_distinct(string_split(v, ''))) >= 8 AND regexp_matches(v, '[0-9]')
         AND NOT regexp_matches(v, '{PLACEHOLDER}') AS live FROM ({_oracle_kind(3, RUN, 0, 16)})),
known AS (SELECT r.* FROM runs r WHERE r.live AND r.sha IN (SELECT sha FROM base WHERE live)
          AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = r.rid AND b.s < r.e AND r.s < b.e)),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM known),
counts AS (SELECT sha, count(DISTINCT owner) AS n_owners FROM spans JOIN d USING (rid) GROUP BY sha),
listed AS (SELECT rid, kind, s, list_value('assign', 'access', 'hex', 'known')[kind + 1] || ':' || s || ':' || e AS txt,
           n_owners, live FROM spans JOIN counts USING (sha)),
per AS (SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
        count(*) FILTER (kind = 2) AS n_hex, string_agg(txt, ',' ORDER BY s, kind) FILTER (kind < 3) AS base_txt,
        string_agg(txt, ',' ORDER BY s, kind) AS all_txt, count(*) FILTER (n_owners >= 5) AS n_copied,
        count(*) FILTER (n_owners < 5 AND live) AS n_live FROM listed GROUP BY rid)
SELECT rid AS doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base_txt, '')) AS base_sha256, coalesce(all_txt, '') AS spans,
       coalesce(n_copied, 0) AS n_copied, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN per USING (rid)
"""
