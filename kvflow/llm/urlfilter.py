"""URL filter by character language models of accepted and rejected URLs.  DataFrame functions only.

Host rules decide what they fit.  For the rest, two models are learned from the URLs that the rules accept and reject:
the chance of a character after up to ORDER characters before it, smoothed with its chance after one less, and so on to
none, so a context counts as far as it was seen (variable order).  Counts stand in a table that grows with the pages.  A
URL's score is its log-likelihood difference (accepted less rejected) by character; the cut between allow and block has
the least balanced error on rule-decided URLs that the models were not learned from: those whose MD5 begins below
HELD_OUT.  Where these lack a class, all rule-decided URLs stand in for them.

Defined results: null URLs and those without ``://`` have empty host and path and no rule, and are blocked; so is no
other URL where rules leave accepted or rejected URLs without an example.  Repeated rows get equal results.  An empty
table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kvflow.llm.common import lower_ascii, materialise

#: Fixed values: (verdict, host and path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
MAX_RULES = 1000
#: Weight of the shorter context in the longer one's estimate, in observations.
BACKOFF = 4.0
#: Characters of context that are counted, and the mark of a text's start.
ORDER, START = 6, "\x02"
#: URLs kept for calibration: those whose MD5 begins with a lesser hexadecimal digit.
HELD_OUT = "3"
#: Scores are cut to this range, and calibrated in steps of BIN.
RANGE, BIN = 8.0, 0.01


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, g), F.lit("")) for g in (1, 2))
    return lower_ascii(host), path


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    rule, verdict = [], []
    for v, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(slash + p)
        rule.append(F.when(fits, F.lit(text)))
        verdict.append(F.when(fits, F.lit(v)))
    none = F.lit(None).cast("string")
    return F.coalesce(*rule, none), F.coalesce(*verdict, none)


def calibrate(scored: DataFrame) -> DataFrame:
    """scored: accepted, score.  One row, cut: the score at and above which the balanced error is least; the lowest of equals.
    Null where a class has no example."""
    bins = scored.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(
        F.sum(F.col("accepted").cast("long")).alias("yes"), F.sum((~F.col("accepted")).cast("long")).alias("no")
    )
    every = Window.partitionBy(F.lit(0))  # at most 2 * RANGE / BIN rows
    below = every.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    missed = F.coalesce(F.sum("yes").over(below), F.lit(0)) / F.sum("yes").over(every)
    passed = 1 - F.coalesce(F.sum("no").over(below), F.lit(0)) / F.sum("no").over(every)
    errors = bins.select("bin", F.when((F.sum("yes").over(every) > 0) & (F.sum("no").over(every) > 0), missed + passed).alias("error"))
    return errors.agg((F.min_by("bin", F.struct("error", "bin")) * BIN).alias("cut"), F.max("error").alias("error")).select(F.when(F.col("error").isNotNull(), F.col("cut")).alias("cut"))


def characters(url: Column) -> Column:
    """What stands after ``://``, lower-cased, character by character: digits, letters of any script and all others as they are."""
    return F.lower(F.regexp_replace(url, r"(?s)^.*?://", ""))


def contexts(text: Column, order: int) -> Column:
    """For each character of text the string of up to order characters before it (with the text's start marked) and itself."""
    padded = F.concat(F.lit(START), text)
    place = F.sequence(F.lit(2), F.length(padded))
    return F.when(F.length(text) > 0, F.transform(place, lambda i: F.substring(padded, F.greatest(F.lit(1), i - order), F.least(i, F.lit(order + 1))))).otherwise(F.array().cast("array<string>"))


def fit(examples: DataFrame, order: int = ORDER) -> DataFrame:
    """examples: accepted (boolean), shown.  gram, yes, no, yes_all, no_all: how often the last character of gram follows
    the rest of it and how often anything does, in either sort of URLs.  Grams of 1 to order + 1 characters, those seen."""
    each = examples.select("accepted", F.explode(contexts(F.col("shown"), order)).alias("longest"))
    whole = each.groupBy("longest").agg(F.sum(F.col("accepted").cast("long")).alias("yes"), F.sum((~F.col("accepted")).cast("long")).alias("no"))
    ends = whole.select(F.explode(_tails("longest")).alias("gram"), "yes", "no")
    counts = ends.groupBy("gram").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    counts = materialise(counts.withColumn("context", F.expr("left(gram, length(gram) - 1)")), "url-counts")
    totals = counts.groupBy("context").agg(F.sum("yes").alias("yes_all"), F.sum("no").alias("no_all"))
    return materialise(totals.join(counts.select("context", "gram", "yes", "no"), "context", "left").select("gram", "context", "yes", "no", "yes_all", "no_all"), "url-model")


def _tails(longest: str) -> Column:
    """The ends of a string, shortest first."""
    return F.transform(F.sequence(F.lit(1), F.length(longest)), lambda n: F.substring(F.col(longest), -n, n))


def score(parsed: DataFrame, model: DataFrame) -> DataFrame:
    """longest, ratio: the log-likelihood difference of each longest gram that parsed (shown) holds.

    The chance of a character after a context is smoothed by that after the context less its first character, and so on to
    the even chance of the characters seen; a context that was never seen leaves the shorter one's chance as it is.
    """
    wanted = parsed.select(F.explode(contexts(F.col("shown"), ORDER)).alias("longest")).distinct()
    ends = wanted.select("longest", F.posexplode(_tails("longest")).alias("n", "gram"))
    ends = ends.withColumn("context", F.expr("left(gram, length(gram) - 1)"))
    counts = model.select(F.col("gram"), "yes", "no")
    totals = model.select("context", "yes_all", "no_all").distinct()
    met = ends.join(counts, "gram", "left").join(totals, "context", "left").na.fill(0, ["yes", "no", "yes_all", "no_all"])
    steps = met.groupBy("longest").agg(F.array_sort(F.collect_list(F.struct("n", "yes", "no", "yes_all", "no_all"))).alias("steps"))
    kinds = materialise(model.where("length(gram) = 1").agg((F.count("*") + 1).alias("kinds")), "url-kinds")

    def chance(n: str) -> Column:
        return F.aggregate("steps", 1.0 / F.col("kinds"), lambda p, s: (s[n] + BACKOFF * p) / (s[f"{n}_all"] + BACKOFF))

    return steps.withColumn("kinds", kinds.scalar()).select("longest", (F.log(chance("yes")) - F.log(chance("no"))).alias("ratio"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """id_col, host, path, rule, verdict, score: a row for each row of pages."""
    url = F.col(url_col).cast("string")
    host, path = host_and_path(url)
    parsed = pages.select(F.col(id_col), url.alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumns({"rule": rule, "ruled": verdict, "shown": F.coalesce(characters(F.col("url")), F.lit(""))})
    parsed = parsed.withColumn("is_url", F.coalesce(F.contains("url", F.lit("://")), F.lit(False)))
    parsed = materialise(parsed.withColumn("held_out", F.coalesce(F.substring(F.md5("url"), 1, 1) < HELD_OUT, F.lit(False))).drop("url"), "urls")
    accepted = F.col("ruled") == "allow"
    ratios = score(parsed, fit(parsed.where("ruled is not null and not held_out").withColumn("accepted", accepted)))
    # Each distinct URL once: its grams meet their ratios by a join, and come together by the URL.
    distinct = parsed.select("shown").distinct()
    each = distinct.select("shown", F.explode(contexts(F.col("shown"), ORDER)).alias("longest"))
    sums = each.join(ratios, "longest").groupBy("shown").agg(F.avg("ratio").alias("mean"))
    bounded = F.coalesce(F.greatest(F.lit(-RANGE), F.least(F.lit(RANGE), F.round("mean", 9))), F.lit(0.0))
    scored = materialise(parsed.join(sums, "shown", "left").withColumn("score", bounded).drop("shown", "mean"), "url-scores")
    known = scored.where("ruled is not null").withColumn("accepted", accepted)
    cuts = calibrate(known.where("held_out")).select(F.lit(0).alias("n"), "cut").union(calibrate(known).select(F.lit(1), "cut"))
    cut = materialise(cuts.agg(F.min_by("cut", F.when(F.col("cut").isNotNull(), F.col("n"))).alias("cut")), "url-cut")
    by_model = F.when(~F.col("is_url"), "block").when(F.col("cut").isNull() | (F.col("score") >= F.col("cut")), "allow").otherwise("block")
    return scored.withColumn("cut", cut.scalar()).select(id_col, "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score")


_FITS = " ".join(
    f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '/{p}') then '{v}:{r}'"
    for v, r in sorted(RULES, key=lambda r: (-len(r[1]), r[1]))
    for h, _, p in [r.partition("/")]
)
_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_CUT = f"""select min_by(bin, struct_pack(error := error, bin := bin)) * {BIN} as cut from (
  select bin, coalesce(sum(y) over (order by bin rows between unbounded preceding and 1 preceding), 0) / sum(y) over () +
    (1 - coalesce(sum(n) over (order by bin rows between unbounded preceding and 1 preceding), 0) / sum(n) over ()) as error
  from (select floor(score / {BIN}) as bin, count(*) filter (ruled = 'allow') as y, count(*) filter (ruled = 'block') as n from scored where ruled is not null and ({{0}}) group by 1)
  qualify sum(y) over () > 0 and sum(n) over () > 0)"""
ORACLE_SQL = f"""
with split as (select page_id, url, translate(coalesce(regexp_extract(url, '{_PATTERN}', 1), ''), {_LETTERS}) as host, coalesce(regexp_extract(url, '{_PATTERN}', 2), '') as path from pages),
fitted as (select *, case {_FITS} end as fit from split),
parsed as (select row_number() over () as r, page_id, host, path, substr(fit, 7) as rule, substr(fit, 1, 5) as ruled, coalesce(contains(url, '://'), false) as is_url,
  coalesce(md5(url)[1] < '{HELD_OUT}', false) as held_out, coalesce(lower(regexp_replace(url, '(?s)^.*?://', '')), '') as shown from fitted),
each as (select r, ruled, held_out, substr(pad, greatest(1, i - {ORDER}), least(i, {ORDER + 1})) as longest
  from (select *, chr(2) || shown as pad, unnest(range(2, length(shown) + 2)) as i from parsed)),
whole as (select longest, count(*) filter (ruled = 'allow') as y, count(*) filter (ruled = 'block') as n from each where ruled is not null and not held_out group by longest),
counts as (select gram, sum(y) as y, sum(n) as n from (select unnest([right(longest, k) for k in range(1, length(longest) + 1)]) as gram, y, n from whole) group by gram),
totals as (select left(gram, length(gram) - 1) as context, sum(y) as y_all, sum(n) as n_all from counts group by 1),
kinds as (select count(*) + 1 as kinds from counts where length(gram) = 1),
ends as (select longest, unnest(range(1, length(longest) + 1)) as k from (select distinct longest from each)),
steps as (select longest, list(struct_pack(y := coalesce(y, 0)::double, n := coalesce(n, 0)::double, ya := coalesce(y_all, 0)::double, na := coalesce(n_all, 0)::double) order by k) as steps
  from ends left join counts on gram = right(longest, k) left join totals on context = left(right(longest, k), k::int - 1) group by longest),
ratios as (select longest, ln(p.y) - ln(p.n) as ratio from (select longest, list_reduce(list_prepend(struct_pack(y := 1.0::double / kinds, n := 1.0::double / kinds, ya := 0::double, na := 0::double), steps),
  lambda a, b: struct_pack(y := (b.y + {BACKOFF} * a.y) / (b.ya + {BACKOFF}), n := (b.n + {BACKOFF} * a.n) / (b.na + {BACKOFF}), ya := 0::double, na := 0::double)) as p from steps, kinds)),
scored as (select p.*, coalesce(greatest(-{RANGE}, least({RANGE}, round(mean, 9))), 0) as score from parsed p left join (select r, avg(ratio) as mean from each join ratios using (longest) group by r) using (r)),
cut as (select coalesce(({_CUT.format("held_out")}), ({_CUT.format("true")})) as cut)
select page_id, host, path, nullif(rule, '') as rule, case when ruled in ('allow', 'block') then ruled when not is_url then 'block' when cut is null or score >= cut then 'allow' else 'block' end as verdict, cast(score as double) as score
from scored, cut
"""
