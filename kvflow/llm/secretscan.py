"""Secret scans with corpus-wide ownership.  DataFrame functions only.

Base patterns give spans of three kinds in every text.  Beside them, long mixed tokens are candidates: runs of the
base64 alphabet with ``+``, ``/`` or ``=`` in them that look random as a whole, and else runs of letters, digits, ``_``
and ``-``.  Paths and URLs change too seldom between sorts of characters, or have too many slashes, to be taken whole.  The SHA-256 of
each secret value is counted over the corpus by distinct repositories and owners: a value that many owners hold is an
example copied around, one held by at most MAX_OWNERS owners in at most MAX_REPOSITORIES repositories and of mixed
characters looks live.  Candidates that look live become spans of kind ``token``; base spans always stay, and their
values are counted the same way.  Unless columns name it, a repository is a document, copies of one text being one;
its owner is its source.

Each pattern is two built-in calls, which give every match and the characters before it.  Places are running sums of
these lengths in a window over the document's matches, and spans that overlap are found by running maxima, so a text of
n matches costs n log n.

Defined results: null counts as empty; a null source is an owner of its own; rows that repeat in full give equal
results and count once by owner.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kvflow.llm.common import materialise

#: Kind -> pattern, the group that holds the secret, its least length.  Order is the order among equal starts.
ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
BASE = {"assign": (ASSIGN, 2, 6), "access": (r"AKIA[A-Z0-9]{16,}", 0, 20), "hex": (r"[0-9a-f]{24,}", 0, 24)}
#: Candidates beside them: maximal runs of at least so many of these.
CANDIDATE = r"[A-Za-z0-9_-]"
CANDIDATE_MIN = 24
#: And maximal runs of so many of these with their padding, where they look random.
WIDE = rf"[A-Za-z0-9+/_-]{{{CANDIDATE_MIN},}}={{0,2}}"
#: Ends of stretches of lower case, upper case or digits for each character: random base64 has 0.6, words less than 0.25.
MIN_CHANGES = 0.3
#: A random run has a slash in 64 characters, a path has more than one in so many.
SLASH_EVERY = 6
MAX_OWNERS = 2
MAX_REPOSITORIES = 3
#: A live-looking value has this many distinct characters.
MIN_DISTINCT = 10
#: Kinds by number: those of BASE, then candidates of the narrow and of the wide alphabet.
TOKEN, WIDER = len(BASE), len(BASE) + 1


def _is_key(run: Column) -> Column:
    """Whether a run with +, / or = inside looks like one random value: all three sorts of characters, changing often, few slashes."""
    changes = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"
    sorts = run.rlike("[a-z]") & run.rlike("[A-Z]") & run.rlike("[0-9]")
    slashes = F.regexp_count(run, F.lit("/")) * SLASH_EVERY <= F.length(run)
    return run.rlike("[+/=]") & sorts & slashes & (F.regexp_count(run, F.lit(changes)) >= F.length(run) * MIN_CHANGES)


def _mixed(s: Column) -> Column:
    return s.rlike("[0-9]") & s.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(s, ""))) >= MIN_DISTINCT)


def _matches(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """kind, n, gap, length, secret, mixed, valid of each leftmost non-overlapping match: gap characters stand between the
    match before and this one; secret is the SHA-256 of its group."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0).alias("match")
    named = [found, F.split(text, pattern, -1).alias("gap")]
    if group:
        named.append(F.regexp_extract_all(text, F.lit(pattern), group).alias("secret"))

    def described(x: Column, n: Column) -> Column:
        secret = x["secret"] if group else x["match"]
        valid = _is_key(secret) if kind == WIDER else F.length(secret) >= least
        return F.struct(
            F.lit(kind).alias("kind"), n.alias("n"), F.length(x["gap"]).alias("gap"), F.length(x["match"]).alias("length"),
            F.unhex(F.sha2(secret, 256)).alias("secret"), _mixed(secret).alias("mixed"), valid.alias("valid"),
        )

    # The characters after the last match have no match beside them.
    whole = F.transform(F.filter(F.arrays_zip(*named), lambda x: x["match"].isNotNull()), described)
    none = F.array().cast("array<struct<kind:int,n:int,gap:int,length:int,secret:binary,mixed:boolean,valid:boolean>>")
    return F.when(text.rlike(pattern), whole).otherwise(none)


def _spans(found: DataFrame) -> DataFrame:
    """row, owner, repository, kind, start, stop, secret, mixed of base matches and of candidates apart from them.

    found: row, owner, repository, matches.  A document's matches meet in one task, sorted.
    """
    each = found.select("row", "owner", "repository", F.explode("matches").alias("m")).select("row", "owner", "repository", "m.*").repartition("row")
    order = Window.partitionBy("row", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("stop", F.sum(F.col("gap") + F.col("length")).over(order)).withColumn("start", F.col("stop") - F.col("length")).where("valid")
    before, after = Window.partitionBy("row").orderBy("start"), Window.partitionBy("row").orderBy(F.desc("start"))

    def met(of: Column) -> Column:
        """Whether a span of these overlaps this one: it starts no later and ends inside or after, or starts inside."""
        ends, starts = F.max(F.when(of, F.col("stop"))).over(before), F.min(F.when(of, F.col("start"))).over(after)
        return F.coalesce(ends > F.col("start"), F.lit(False)) | F.coalesce(starts < F.col("stop"), F.lit(False))

    kind = F.col("kind")
    each = each.withColumns({"in_base": met(kind < TOKEN), "in_wide": met(kind == WIDER)})
    each = each.where((kind < TOKEN) | (F.col("mixed") & ~F.col("in_base") & ((kind == WIDER) | ~F.col("in_wide"))))
    return each.select("row", "owner", "repository", F.least(kind, F.lit(TOKEN)).alias("kind"), "start", "stop", "secret", "mixed")


def _digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined; spans: array of (start, kind, stop)."""
    names = F.array(*map(F.lit, [*BASE, "token"]))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_cols: tuple[str, ...] = ()) -> DataFrame:
    """id_col, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied: a row for each row of docs.

    n_live and n_copied count the spans whose value looks live, and those whose value many owners hold.
    repository_cols: what tells repositories apart; without any each text is one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    known = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in repository_cols]
    patterns = [(*BASE[k], i) for i, k in enumerate(BASE)] + [(f"{CANDIDATE}{{{CANDIDATE_MIN},}}", 0, CANDIDATE_MIN, TOKEN), (WIDE, 0, CANDIDATE_MIN, WIDER)]
    found = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.coalesce(F.concat(F.lit("="), F.col(owner_col).cast("string")), F.lit("")).alias("owner"),
        F.xxhash64(*known or [text]).alias("repository"),
        F.concat(*[_matches(text, p, group, least, kind) for p, group, least, kind in patterns]).alias("matches"),
    )
    # Written with its row numbers, which a task that is run again would otherwise deal anew.
    found = materialise(found, "secrets")
    each = materialise(_spans(found), "secret-spans")
    held = each.select("secret", "owner", "repository").distinct().groupBy("secret")
    held = held.agg(F.countDistinct("owner").alias("owners"), F.count("*").alias("repositories"))
    held = held.select("secret", (F.col("owners") > MAX_OWNERS).alias("copied"), ((F.col("owners") <= MAX_OWNERS) & (F.col("repositories") <= MAX_REPOSITORIES)).alias("own"))
    # Written, so that the join deals both sides anew and a value that very many documents hold can be split over tasks.
    judged = each.join(materialise(held, "secret-owners"), "secret").withColumn("live", F.col("mixed") & F.col("own"))
    span = F.struct("start", "kind", "stop")
    is_base = F.col("kind") < TOKEN
    by_row = judged.groupBy("row").agg(
        *[F.sum((F.col("kind") == i).cast("long")).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.array_sort(F.collect_list(F.when(is_base, span))).alias("base"),
        F.array_sort(F.collect_list(F.when(is_base | F.col("live"), span))).alias("all"),
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.sum(F.col("copied").cast("long")).alias("n_copied"),
    )
    zero = F.lit(0).cast("long")
    return found.select("row", "id").join(by_row, "row", "left").select(
        F.col("id").alias(id_col),
        *[F.coalesce(f"n_{k}", zero).alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce(_digest(F.col("base")), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(_digest(F.col("all")), F.lit("")).alias("spans"),
        *[F.coalesce(c, zero).alias(c) for c in ("n_live", "n_copied")],
    )


def _sql_matches(kind: int, pattern: str, secret: int, valid: str) -> str:
    p = pattern.replace("'", "''")
    return (
        f"select r, {kind} as kind, n, length(gap) + length(m) as step, length(m) as len, s, ({valid}) as valid from (select r, "
        f"unnest(regexp_extract_all(t, '{p}', 0)) as m, unnest(regexp_extract_all(t, '{p}', {secret})) as s, unnest(regexp_split_to_array(t, '{p}')) as gap, "
        f"unnest(range(len(regexp_split_to_array(t, '{p}')))) as n from d) where m is not null"
    )


#: No case flag: it would add letters beyond ASCII here.
_ASSIGN_SQL = "(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
_SORT = "case when {0} between 'a' and 'z' then 1 when {0} between 'A' and 'Z' then 2 when {0} between '0' and '9' then 3 else 0 end"
_IS_KEY = (
    "regexp_matches(s, '[+/=]') and regexp_matches(s, '[a-z]') and regexp_matches(s, '[A-Z]') and regexp_matches(s, '[0-9]') "
    f"and (length(s) - length(replace(s, '/', ''))) * {SLASH_EVERY} <= length(s) and "
    f"len(list_filter(range(1, length(s)), lambda i: {_SORT.format('s[i]')} > 0 and {_SORT.format('s[i]')} <> {_SORT.format('s[i + 1]')})) >= length(s) * {MIN_CHANGES}"
)
ORACLE_SQL = f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, coalesce('=' || source, '') as owner from documents),
m as (
  {_sql_matches(0, _ASSIGN_SQL, 2, "length(s) >= 6")}
  union all {_sql_matches(1, BASE["access"][0], 0, "true")}
  union all {_sql_matches(2, BASE["hex"][0], 0, "true")}
  union all {_sql_matches(3, f"{CANDIDATE}{{{CANDIDATE_MIN},}}", 0, "true")}
  union all {_sql_matches(4, WIDE, 0, _IS_KEY)}
),
p as (select *, sum(step) over (partition by r, kind order by n) as stop from m),
s as (select r, kind, cast(stop - len as bigint) as start, cast(stop as bigint) as stop, s,
  regexp_matches(s, '[0-9]') and regexp_matches(s, '[A-Za-z]') and len(list_distinct(string_split(s, ''))) >= {MIN_DISTINCT} as mixed from p where valid),
k as (select * from s where kind < 3 or (mixed
  and not exists (select 1 from s b where b.r = s.r and b.kind < 3 and b.start < s.stop and s.start < b.stop)
  and (kind = 4 or not exists (select 1 from s w where w.r = s.r and w.kind = 4 and w.start < s.stop and s.start < w.stop)))),
h as (select s, count(distinct owner) as owners, count(distinct row(owner, t)) as repositories from k join d using (r) group by s),
j as (select k.r, least(kind, 3) as kind, start, stop, owners > {MAX_OWNERS} as copied,
  mixed and owners <= {MAX_OWNERS} and repositories <= {MAX_REPOSITORIES} as live from k join h using (s)),
g as (select r, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
  string_agg(['assign', 'access', 'hex', 'token'][kind + 1] || ':' || start || ':' || stop, ',' order by start, kind, stop) filter (kind < 3) as base,
  string_agg(['assign', 'access', 'hex', 'token'][kind + 1] || ':' || start || ':' || stop, ',' order by start, kind, stop) filter (kind < 3 or live) as spans,
  count(*) filter (live) as n_live, count(*) filter (copied) as n_copied from j group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
  coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied
from d left join g using (r)
"""
