"""Secret scans with corpus-wide ownership frequency.

Three patterns give the base spans of every text: assignments of a credential word, access keys and long hexadecimal
runs. Their values are candidates; so is any bare run of credential characters, which counts only where the same value
is a candidate of a pattern elsewhere. Candidate hashes are aggregated by the repositories and owners that have them:
a value that many owners share, or that very many repositories of few owners hold, is a copied example; any other value
that looks random is its owner's live credential. The spans of the classified values are added to the base spans.

All work is DataFrame expressions over three scans of the texts: the first finds the base spans, the second the bare
runs, of which only those stay that an equi-join with the values of the patterns finds, the third their places in the
texts that have any. Places come from the pieces between
matches, in code points. Aggregation goes by (hash, owner, repository) first, so a value that a third of the documents
hold is counted in many tasks; it goes back to the documents by a plain join whose hot partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialguard.llm.common import staged

# The base patterns.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
#: Bare candidates: runs of credential characters as long as the shortest value of a pattern.
LEAST_BARE = LEAST_ASSIGN
#: A value that this many owners have, or this many repositories, is a copied example.
EXAMPLE_OWNERS, EXAMPLE_REPOS = 4, 20
#: What a live-looking value has at least: characters, and different ones.
LIVE_LENGTH, LIVE_CHARACTERS = 16, 8
#: Matches whose places are summed up in a row; a text with many matches is walked in chunks.
CHUNK = 256
KINDS = ("assign", "access", "hex", "live", "example")
SPAN = "array<struct<start:bigint,stop:bigint,value:string>>"


def _steps(text: Column, pattern: str, matches: Column, values: Column) -> Column:
    """For each match the length of the text between it and the one before, its own length, and its value."""
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
    lengths = F.transform(matches, lambda x: F.length(x).cast("long"))
    steps = F.arrays_zip(
        F.slice(between, 1, F.size(matches)).alias("gap"), lengths.alias("n"), values.alias("value")
    )
    return F.when(F.size(matches) > 0, steps).otherwise(
        F.array().cast("array<struct<gap:bigint,n:bigint,value:string>>")
    )


def _chunk(steps: Column, k: Column) -> Column:
    return F.slice(steps, k * CHUNK + 1, F.lit(CHUNK))


def _chunk_lengths(steps: Column) -> Column:
    """Length of text that each ``CHUNK`` steps take, so that places in a chunk start from a sum of few numbers."""
    chunks = F.sequence(F.lit(0), F.ceil(F.size(steps) / CHUNK).cast("int") - 1)
    lengths = F.transform(
        chunks, lambda k: F.aggregate(_chunk(steps, k), F.lit(0).cast("long"), lambda a, s: a + s["gap"] + s["n"])
    )
    return F.when(F.size(steps) > 0, lengths).otherwise(F.array().cast("array<bigint>"))


def _places(steps: Column, lengths: Column, wanted) -> Column:
    """Spans of the matches whose value is ``wanted``: ``start, stop`` in code points, and the value."""
    empty = F.array().cast(SPAN)

    def span(at: Column, s: Column) -> Column:
        start = at + s["gap"]
        return F.struct(start.alias("start"), (start + s["n"]).alias("stop"), s["value"].alias("value"))

    def walked(k: Column) -> Column:
        before = F.aggregate(F.slice(lengths, F.lit(1), k), F.lit(0).cast("long"), lambda a, x: a + x)
        return F.aggregate(
            _chunk(steps, k),
            F.struct(before.alias("at"), empty.alias("spans")),
            lambda acc, s: F.struct(
                (acc["at"] + s["gap"] + s["n"]).alias("at"),
                F.when(wanted(s["value"]), F.concat(acc["spans"], F.array(span(acc["at"], s))))
                .otherwise(acc["spans"]).alias("spans"),
            ),
            lambda acc: acc["spans"],
        )

    return F.flatten(F.transform(lengths, lambda _, k: walked(k)))


#: Patterns, the group that is the value, and the least length of the value. A run that is long enough is the same match
#: as a run of any length, where all runs are matched whole.
PATTERNS = {
    "assign": (ASSIGN, 2, LEAST_ASSIGN),
    "access": (f"AKIA[A-Z0-9]{{{LEAST_ACCESS - 4},}}", 0, LEAST_ACCESS),
    "hex": (f"[0-9a-f]{{{LEAST_HEX},}}", 0, LEAST_HEX),
    "bare": (f"[A-Za-z0-9+/_.=-]{{{LEAST_BARE},}}", 0, LEAST_BARE),
}


def _long_enough(least: int):
    return lambda value: F.length(value) >= least


def _scanned(rows: DataFrame, *kinds: str, only: str | None = None) -> DataFrame:
    """``row, id, owner, repo`` and the spans of each of ``kinds`` of ``rows(row, id, owner, repo, text)``.

    ``only`` names an array column of the values that count; else those that are long enough do.
    """
    patterns = {k: PATTERNS[k] for k in kinds}
    keys, text = ["row", "id", "owner", "repo", *([only] if only else [])], F.col("text")
    found = rows.select(
        *keys, "text", *(F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(k) for k, (p, _, _) in patterns.items())
    )
    steps = found.select(
        *keys,
        *(
            _steps(text, p, F.col(k), F.regexp_extract_all(text, F.lit(p), F.lit(group)) if group else F.col(k)).alias(k)
            for k, (p, group, _) in patterns.items()
        ),
    )
    steps = steps.select("*", *(_chunk_lengths(F.col(k)).alias(f"{k}_lengths") for k in patterns))

    def places(kind: str) -> Column:
        wanted = (lambda value: F.array_contains(only, value)) if only else _long_enough(PATTERNS[kind][2])
        return _places(F.col(kind), F.col(f"{kind}_lengths"), wanted)

    return steps.select(*keys, *(places(k).alias(k) for k in patterns))


def classes(
    candidates: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS
) -> DataFrame:
    """``hash, class, owners, repos`` of the values in ``candidates(hash, value_ok, owner, repo)``.

    A repository is one of its owner's: the same name under two owners is two repositories.
    """
    repos = candidates.groupBy("hash", "owner", "repo").agg(F.max("value_ok").alias("ok"))
    owners = repos.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"), F.max("ok").alias("ok"))
    values = owners.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"), F.max("ok").alias("ok")
    )
    copied = (F.col("owners") >= example_owners) | (F.col("repos") >= example_repos)
    return values.withColumn("class", F.when(copied, "example").when(F.col("ok"), "live")).where("class is not null")


def _live_looking(value: Column) -> Column:
    return (
        (F.length(value) >= LIVE_LENGTH) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_CHARACTERS)
    )


def _written(spans: Column) -> Column:
    """``kind:start:end`` of sorted structs ``start, place, stop``, comma-joined; ``place`` numbers the kind."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["place"] + 1), s["start"], s["stop"])), ","
    )


def _candidates(scanned: DataFrame, spans: Column) -> DataFrame:
    """A row for each of the ``spans``: ``row, owner, repo, start, stop, value``."""
    return scanned.select("row", "owner", "repo", F.explode(spans).alias("c")).select("row", "owner", "repo", "c.*")


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    repo_col: str = "doc_id", example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS,
) -> DataFrame:
    """Spans of secrets for each row of ``docs``.

    ``id_col, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, n_owners, n_repos``: counts and digest of
    the base spans, all spans as ``kind:start:end`` by start and kind, the numbers of spans of classified values, and of
    these values the most owners and the most repositories that one has (0 without one). A null text is empty; a null
    owner is an owner of its own, a null repository one repository. Repeated rows count as the same repository and
    owner. An empty table gives no rows; other columns are not read.
    """
    owner = F.when(F.col(owner_col).isNull(), F.lit("1")).otherwise(
        F.concat(F.lit("0"), F.col(owner_col).cast("string"))
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), owner.alias("owner"), F.col(repo_col).alias("repo"), text.alias("text"),
    )
    # rows that agree in all that is read have the same spans, so both scans can name them alike
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("id", "owner", "repo", "text")]
    nulls = F.concat(*(F.col(c).isNull().cast("string") for c in ("id", "repo")))
    rows = rows.withColumn("row", F.unhex(F.sha2(F.concat_ws("\n", nulls, *(F.sha2(p, 256) for p in parts)), 256)))
    scanned = staged(_scanned(rows, "assign", "access", "hex"), "secrets")
    in_assign = F.transform("assign", lambda s: F.struct(
        (s["stop"] - F.length(s["value"])).alias("start"), s["stop"].alias("stop"), s["value"].alias("value")))
    of_patterns = staged(_candidates(scanned, F.concat(in_assign, "access", "hex")), "values")
    known_values = staged(of_patterns.select("value").distinct(), "known_values")
    # places are worked out only in the texts, and only for the runs, that have such a value
    runs = F.regexp_extract_all("text", F.lit(PATTERNS["bare"][0]), F.lit(0))
    held = rows.select("row", F.explode(F.array_distinct(runs)).alias("value")).join(known_values, "value", "left_semi")
    wanted = staged(held.groupBy("row").agg(F.collect_set("value").alias("wanted")), "wanted")
    bare = _candidates(_scanned(rows.join(wanted, "row"), "bare", only="wanted"), F.col("bare"))
    found = of_patterns.unionByName(staged(bare.select(*of_patterns.columns), "bare"))
    candidates = found.select(
        "row", "owner", "repo", "start", "stop", F.sha2("value", 256).alias("hash"), _live_looking(F.col("value")).alias("value_ok")
    )
    known = classes(candidates, example_owners, example_repos)
    place = F.when(F.col("class") == "live", KINDS.index("live")).otherwise(KINDS.index("example"))
    added = candidates.join(known, "hash").groupBy("row").agg(
        F.collect_set(F.struct("start", place.alias("place"), "stop")).alias("added"),
        F.max("owners").alias("owners"), F.max("repos").alias("repos"),
    )
    base = F.concat(
        *(
            F.transform(k, _at(place))
            for place, k in enumerate(("assign", "access", "hex"))
        )
    )
    more = F.coalesce("added", F.array().cast("array<struct<start:bigint,place:int,stop:bigint>>"))
    return scanned.join(added, "row", "left").select(
        F.col("id").alias(id_col),
        *(F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(_written(F.array_sort(base)), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat(base, more))).alias("spans"),
        *(
            F.size(F.filter(more, _is(KINDS.index(k)))).cast("long").alias(f"n_{k}")
            for k in ("live", "example")
        ),
        *(F.coalesce(c, F.lit(0).cast("long")).alias(f"n_{c}") for c in ("owners", "repos")),
    )


def _at(place: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("place"), s["stop"].alias("stop"))


def _is(place: int):
    return lambda s: s["place"] == place


def _sql_spans(place: int, pattern: str, least: int, group: int = 0) -> str:
    """Spans of a pattern: its matches in turn, each after the pieces of text and the matches before it."""
    p = pattern.replace("'", "''")
    return f"""
  SELECT rid, {place} AS place, stop - length(found) AS start, stop, val AS value FROM (
    SELECT rid, found, val, (sum(length(gap) + length(found)) OVER (PARTITION BY rid ORDER BY k))::BIGINT AS stop FROM (
      SELECT rid, unnest(range(len(found))) AS k, unnest(gaps[1:len(found)]) AS gap, unnest(found) AS found, unnest(vals) AS val
      FROM (SELECT rid, regexp_split_to_array(text, '{p}') AS gaps, regexp_extract_all(text, '{p}', 0) AS found,
        regexp_extract_all(text, '{p}', {group}) AS vals FROM docs)))
  WHERE length(val) >= {least}"""


#: Written from the contract and the method, with their own numbers.
SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
base AS ({_sql_spans(0, """((?i:password|passwd|secret|token|api_?key))["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2)}
  UNION ALL {_sql_spans(1, "AKIA[A-Z0-9]+", 20)}
  UNION ALL {_sql_spans(2, "[0-9a-f]+", 24)}),
bare AS ({_sql_spans(9, "[A-Za-z0-9+/_.=-]+", 6)}),
cand AS (
  SELECT rid, CASE place WHEN 0 THEN stop - length(value) ELSE start END AS start, stop, value FROM base
  UNION ALL SELECT rid, start, stop, value FROM bare WHERE value IN (SELECT value FROM base)),
known AS (
  SELECT value, count(DISTINCT source_key) AS owners, count(DISTINCT (source_key, coalesce(doc_id, -1))) AS repos,
    CASE WHEN owners >= 4 OR repos >= 20 THEN 4
    WHEN length(value) >= 16 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
      AND len(list_distinct(string_split(value, ''))) >= 8 THEN 3 END AS place
  FROM cand JOIN (SELECT rid, doc_id, coalesce('0' || source, '1') AS source_key FROM docs) USING (rid) GROUP BY value),
added AS (
  SELECT rid, place, start, stop, max(owners) AS owners, max(repos) AS repos
  FROM cand JOIN known USING (value) WHERE place IS NOT NULL GROUP BY rid, place, start, stop),
spans AS (
  SELECT rid, place, start, stop, 0 AS owners, 0 AS repos FROM base
  UNION ALL SELECT rid, place, start, stop, owners, repos FROM added),
named AS (
  SELECT rid, string_agg(s, ',' ORDER BY start, place, stop) AS spans,
    string_agg(s, ',' ORDER BY start, place, stop) FILTER (place < 3) AS base,
    count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
    count(*) FILTER (place = 2) AS n_hex, count(*) FILTER (place = 3) AS n_live,
    count(*) FILTER (place = 4) AS n_example, max(owners) AS owners, max(repos) AS repos
  FROM (SELECT *, ['assign', 'access', 'hex', 'live', 'example'][place + 1] || ':' || start || ':' || stop AS s
    FROM spans) GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
  coalesce(n_example, 0) AS n_example, coalesce(owners, 0)::BIGINT AS n_owners, coalesce(repos, 0)::BIGINT AS n_repos
FROM docs LEFT JOIN named USING (rid)
"""
