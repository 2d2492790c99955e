"""URL filters: a tree of path templates per host, judged by labelled purity.

DataFrame functions only.

1. Each url gives host and path; runs of digits in a path segment become
   ``#`` and the paths are counted by (host, shape) with the labels of the
   pages' documents: a page's document is the first number in its path.
   All later steps run on these counts.
2. From the root down, one level a step, a segment becomes the wildcard
   ``*`` where its parent has at least ``min_children`` different segments,
   none holding more than ``max_share`` of the parent's pages (a variable
   part), or where the share of good labels under it does not differ from
   that of its siblings (two-proportion z below ``z_limit``): similar
   branches merge.  This goes on until no two shapes share a template that
   has a further segment; a shape alone under its template keeps its rest as
   it is, so a single very long path costs no steps of its own.
3. A template's purity is its share of good labels, smoothed towards the
   share over all labels by ``prior_weight`` labels; below ``min_purity`` it
   is rejected.
4. Given rules come first; of those that fit a url the longest decides.

Defined results: a null url, or one without ``://``, has empty host and path
and no labels; it fits no rule and is judged as its own template.  Repeated
pages are all returned; of repeated labels of a document the least counts;
without labels every purity is 1.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpointed

# fixed values: rules (action, host and path)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), _UPPER, _UPPER.lower())
    return (F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit("")))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, or null."""
    choice = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        at = rule.index("/")
        suffix, prefix = rule[:at], rule[at:]
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        choice = F.when(fits, F.lit(rule)).otherwise(choice)
    return choice


def templates(pages: DataFrame, labels: DataFrame, min_children: int = 20,
              max_share: float = 0.2, z_limit: float = 1.96) -> DataFrame:
    """``(host, shape, template, n, labelled, good)``: the template of every path shape.

    ``pages``: (host, path); ``labels``: (doc_id, quality)."""
    if min_children < 2:
        raise ValueError("an only child is no variable part: min_children must be 2 or more")
    own = labels.groupBy("doc_id").agg(F.min("quality").alias("q")).where("q is not null and doc_id is not null")
    doc = F.try_to_number(F.regexp_extract("path", r"(\d{1,18})", 1), F.lit("9" * 18)).cast("long")
    rows = pages.select("host", shape_of(F.col("path")).alias("shape"), doc.alias("doc_id"))
    shapes = (rows.join(own, "doc_id", "left").groupBy("host", "shape")
              .agg(F.count(F.lit(1)).alias("n"), F.count("q").alias("labelled"),
                   F.coalesce(F.sum(F.when(F.col("q") > 0, 1).otherwise(0)), F.lit(0)).alias("good")))
    # segments not read yet; the first is empty, before the first slash
    rest = F.split(F.col("shape"), "/")
    tree = checkpointed(shapes.select("*", F.slice(rest, F.lit(2), F.size(rest)).alias("rest"),
                                      F.lit("").alias("template")))
    done: list[DataFrame] = []
    while True:
        done.append(tree.where(F.size("rest") == 0).drop("rest"))
        if len(done) > 16:
            done = [checkpointed(reduce(DataFrame.union, done))]
        left = tree.where(F.size("rest") > 0)
        if left.isEmpty():
            return reduce(DataFrame.union, done)
        tree = checkpointed(_next_level(left, min_children, max_share, z_limit))


def _next_level(tree: DataFrame, min_children: int, max_share: float, z_limit: float) -> DataFrame:
    """``tree`` with the next segment of every shape judged and moved to its template."""
    at = tree.withColumn("seg", F.element_at("rest", 1))
    kids = at.groupBy("host", "template", "seg").agg(
        F.sum("n").alias("kn"), F.sum("labelled").alias("kl"), F.sum("good").alias("kg"),
        F.count(F.lit(1)).alias("members"))
    # sums of a parent by aggregation: a parent with very many children is nobody's single group
    parents = kids.groupBy(F.col("host").alias("ph"), F.col("template").alias("pt")).agg(
        F.sum("kn").alias("pn"), F.sum("kl").alias("pl"), F.sum("kg").alias("pg"),
        F.count(F.lit(1)).alias("width"), F.max("kn").alias("widest"), F.sum("members").alias("shapes"))
    over = kids.join(parents, (F.col("host") == F.col("ph")) & (F.col("template") == F.col("pt")))
    variable = (F.col("width") >= min_children) & (F.col("widest") <= F.col("pn") * max_share)
    rest_l, rest_g = F.col("pl") - F.col("kl"), F.col("pg") - F.col("kg")
    pooled = F.try_divide("pg", "pl")
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), F.col("kl")) + F.try_divide(F.lit(1), rest_l)))
    apart = F.abs(F.try_divide("kg", "kl") - F.try_divide(rest_g, rest_l)) >= spread * z_limit
    # branches without labels, or all alike, do not differ
    similar = (F.col("width") > 1) & ~F.coalesce(
        F.when((F.col("kl") > 0) & (rest_l > 0), apart & (spread > 0)), F.lit(False))
    step = over.select(F.col("host").alias("h"), F.col("template").alias("t"), F.col("seg").alias("s"),
                       F.when(variable | similar, F.lit("*")).otherwise(F.col("seg")).alias("part"),
                       (F.col("shapes") == 1).alias("alone"))
    tail = F.slice("rest", F.lit(2), F.size("rest"))
    return (at.join(step, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t"))
                    & (F.col("seg") == F.col("s")))
            .select("host", "shape", "n", "labelled", "good",
                    F.when(F.col("alone"), F.array().cast("array<string>")).otherwise(tail).alias("rest"),
                    F.concat("template", F.lit("/"), F.when(F.col("alone"), F.array_join("rest", "/"))
                             .otherwise(F.col("part"))).alias("template")))


def shape_of(path: Column) -> Column:
    return F.regexp_replace(path, r"\d+", "#")


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
               prior_weight: float = 10.0, min_purity: float = 0.5, **tree) -> DataFrame:
    """Per row of ``pages`` (page_id, url): host, path, rule, verdict, template, purity."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    # read three times below: the tree is grown once
    shapes = checkpointed(templates(urls.select("host", "path"), labels, **tree))
    total = shapes.agg(F.sum("labelled").alias("al"), F.sum("good").alias("ag"))
    prior = F.coalesce(F.try_divide("ag", "al"), F.lit(1.0))
    sums = shapes.groupBy("host", "template").agg(F.sum("labelled").alias("tl"), F.sum("good").alias("tg"))
    # total is one row
    purity = sums.join(F.broadcast(total)).select(
        F.col("host").alias("h"), F.col("template").alias("t"),
        ((F.col("tg") + prior * prior_weight) / (F.col("tl") + prior_weight)).alias("purity"))
    known = (shapes.join(purity, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")))
             .select(F.col("h"), F.col("shape").alias("s"), "template", "purity"))
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    action = F.element_at(F.create_map(*[F.lit(x) for a, r in rules for x in (r, a)]), F.col("rule"))
    method = F.when(F.col("purity") < min_purity, F.lit("block")).otherwise(F.lit("allow"))
    return (urls.withColumn("rule", rule).withColumn("s0", shape_of(F.col("path")))
            .join(known, (F.col("host") == F.col("h")) & (F.col("s0") == F.col("s")), "left")
            .select("page_id", "host", "path", "rule",
                    F.when(F.col("rule").isNotNull(), action).otherwise(method).alias("verdict"),
                    "template", "purity"))


def oracle_sql(min_children: int = 20, max_share: float = 0.2, z_limit: float = 1.96,
               prior_weight: float = 10.0, min_purity: float = 0.5) -> str:
    """The same rows as DuckDB SQL over ``pages`` and ``labels``: the levels by recursion."""
    rule = "null"
    for _, r in sorted(RULES, key=lambda x: len(x[1])):
        at = r.index("/")
        rule = (f"case when (host = '{r[:at]}' or ends_with(host, '.{r[:at]}')) "
                f"and starts_with(path, '{r[at:]}') then '{r}' else {rule} end")
    blocked = ", ".join(f"'{r}'" for a, r in RULES if a == "block")
    parts = f"""with recursive urls as (select page_id,
  translate(coalesce(regexp_extract(url, '(?s)\\A.*?://([^/?#]*)([^?#]*)', 1), ''), '{_UPPER}', '{_UPPER.lower()}') as host,
  coalesce(regexp_extract(url, '(?s)\\A.*?://([^/?#]*)([^?#]*)', 2), '') as path from pages),
own as (select doc_id, min(quality) as q from labels group by 1 having q is not null and doc_id is not null),
tree as (
  select 0 as level, host, shape, count(*) as n, count(q) as labelled,
    coalesce(sum(case when q > 0 then 1 else 0 end), 0)::bigint as good, string_split(shape, '/')[2:] as rest, '' as template
  from (select host, regexp_replace(path, '[0-9]+', '#', 'g') as shape,
      try_cast(nullif(regexp_extract(path, '([0-9]{{1,18}})', 1), '') as bigint) as doc_id from urls)
  left join own using (doc_id) group by host, shape
  union all
  select level + 1, host, shape, n, labelled, good, rest[2:], template || '/' ||
    case when (width >= {min_children} and widest <= pn * {max_share}) or (width > 1 and not coalesce(
      case when kl > 0 and pl - kl > 0 then
        abs(kg / kl - (pg - kg) / (pl - kl)) >= sqrt(pg / pl * (1 - pg / pl) * (1 / kl + 1 / (pl - kl))) * {z_limit}
        and sqrt(pg / pl * (1 - pg / pl) * (1 / kl + 1 / (pl - kl))) > 0 end, false))
      then '*' else seg end
  from (select *, count(distinct seg) over (partition by host, template) as width,
      max(kn) over (partition by host, template) as widest
    from (select *, rest[1] as seg,
        sum(n) over k as kn, sum(labelled) over k as kl, sum(good) over k as kg,
        sum(n) over p as pn, sum(labelled) over p as pl, sum(good) over p as pg
      from tree where len(rest) > 0
      window k as (partition by host, template, rest[1]), p as (partition by host, template)))),
shapes as (select host, shape, labelled, good, template from tree where len(rest) = 0),
purity as (select host, template, (sum(good) + coalesce(any_value(prior), 1.0) * {prior_weight})
    / (sum(labelled) + {prior_weight}) as purity
  from shapes, (select sum(good) / nullif(sum(labelled), 0) as prior from shapes) group by 1, 2),
judged as (select page_id, host, path, {rule} as rule, template, purity
  from (select *, regexp_replace(path, '[0-9]+', '#', 'g') as shape from urls)
  left join (select host, shape, template, purity from shapes join purity using (host, template)) using (host, shape))"""
    return parts + f"""
select page_id, host, path, rule, case when rule is not null then case when rule in ({blocked}) then 'block' else 'allow' end
  when purity < {min_purity} then 'block' else 'allow' end as verdict, template, purity from judged"""
