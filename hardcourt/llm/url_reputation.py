"""URL filter by host reputation: beta-binomial shrinkage from suffix to registered domain to host.

Labelled page outcomes are counted per host. The rate of bad pages of a suffix is shrunk towards the overall rate, that
of a registered domain towards its suffix, that of a host towards its domain; how strongly follows from the spread of
the observed rates (method of moments), per level. A url is blocked when the lower bound of its host's posterior is
above a limit; hosts without labels take the posterior of the nearest level that has some. Explicit rules go first.

What is registered under is a suffix: the last label, or the last two where the last is a country's and the one before it
names a kind of holder there (SECOND_LEVELS), or whatever a longer list of suffixes that the caller gives says.

Nulls and malformed urls have empty host and path, which no rule fits and which share the reputation of the empty host.
Repeated rows are judged each, also those whose page_id is null, which have no outcome; a page labelled more than once
takes the worse outcome. A bound that equals the limit allows. Rules of equal length that fit both: the later one wins.
An empty table gives no rows; further columns of the input are not read. Urls of any length are judged whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hardcourt.llm.runtime import stored, table

#: Rules as (verdict, host/path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Second-level names that registries of countries keep for kinds of holders, as in co.uk, ac.jp, com.au.
SECOND_LEVELS = (
    "ac", "asn", "biz", "co", "com", "csiro", "ed", "edu", "fin", "firm", "gen", "go", "gob", "gouv", "gov", "govt", "gr", "gub", "id", "iwi", "k12", "kiwi", "law", "ltd",
    "maori", "me", "mil", "mod", "muni", "ne", "net", "nhs", "nic", "nom", "or", "org", "plc", "police", "res", "sch", "school", "sld", "tm", "web",
)
#: A host that is an address: four numbers, or what brackets enclose.
ADDRESS = r"^(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|\[.*)$"
BOUND_Z = 1.645
BLOCK_OVER = 0.5
STRENGTH = (1.0, 200.0)


def host_of(url: Column) -> Column:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def domain_parts(host: Column, suffixes: tuple[str, ...] = ()) -> tuple[Column, Column]:
    """Suffix and registered domain of a host, its user, port and closing dots left out. An address in numbers is a domain of
    its own under the suffix "ip". suffixes: more of two labels, such as a host for blogs."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@|:[0-9]*$", ""), r"\.+$", "")
    number = name.rlike(ADDRESS)
    two = F.substring_index(name, ".", -2)
    double = two.rlike(rf"^(?:{'|'.join(SECOND_LEVELS)})\.[a-z]{{2}}$")
    if suffixes:
        double = double | two.isin(*suffixes)
    suffix = F.when(number, "ip").when(double, two).otherwise(F.substring_index(name, ".", -1))
    domain = F.when(number, name).when(double, F.substring_index(name, ".", -3)).otherwise(two)
    return suffix, domain


def _shrunk(both: DataFrame, key: str) -> DataFrame:
    """Posterior (a, b) per key from counts (key, n, bad) and the parent's mean m as prior mean; the prior's strength from
    the spread of rates about it."""
    spread = both.filter("n >= 2").agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("m"), 2)).alias("v"), F.sum(F.col("m") * (1 - F.col("m"))).alias("e0"), F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("e1"), F.count("*").alias("k")
    )  # the driver gets this one row
    # n (rate - m)^2 has mean m (1 - m) (1 + (n - 1) r) where the strength is 1 / r - 1
    got = spread.first()
    low, high = STRENGTH
    s = high
    if got.k and got.e1 - got.e0 > 0 and (r := (got.v - got.e0) / (got.e1 - got.e0)) > 1 / (high + 1):
        s = low if r >= 1 / (low + 1) else 1 / r - 1
    return both.select(key, (s * F.col("m") + F.col("bad")).alias("a"), (s * (1 - F.col("m")) + F.col("n") - F.col("bad")).alias("b"))


def _under(counts: DataFrame, parent: DataFrame, up: str) -> DataFrame:
    return counts.join(parent.select(up, (F.col("a") / (F.col("a") + F.col("b"))).alias("m")), up)


def judged(pages: DataFrame, outcomes: DataFrame, rules=RULES, z: float = BOUND_Z, over: float = BLOCK_OVER, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """page_id, host, path, rule, verdict of each page; outcomes holds (page_id, bad 0/1) for some of them.

    Pages are counted per host before anything is joined, so a host that holds a third of all pages costs one row per
    task; the last join back on the host is an ordinary equi join that Spark may split where a host is large.
    """
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    marks = outcomes.filter("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    labelled = urls.join(marks, "page_id").groupBy("host").agg(F.count("*").cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"))
    suffix, domain = domain_parts(F.col("host"), suffixes)
    hosts = stored(urls.select("host").distinct().join(labelled, "host", "left").select("host", "n", "bad", suffix.alias("suffix"), domain.alias("domain")))
    known = hosts.filter("n is not null")

    def sums(*keys):
        return known.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    whole = known.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()  # two numbers
    n, bad = whole.n or 0.0, whole.bad or 0.0
    by_suffix = _shrunk(sums("suffix").withColumn("m", F.lit((bad + 1) / (n + 2))), "suffix")
    by_domain = _shrunk(_under(sums("suffix", "domain"), by_suffix, "suffix"), "domain")
    by_host = _shrunk(_under(known, by_domain, "domain"), "host")

    def named(df, key, n):
        return df.select(key, F.col("a").alias(f"a{n}"), F.col("b").alias(f"b{n}"))

    near = hosts.select("host", "suffix", "domain")
    for n, (df, key) in enumerate(((by_host, "host"), (by_domain, "domain"), (by_suffix, "suffix"))):
        near = near.join(named(df, key, n), key, "left")
    a, b = (F.coalesce(*(F.col(f"{x}{n}") for n in range(3))) for x in "ab")
    mean = a / (a + b)
    bound = mean - z * F.sqrt(a * b / (F.pow(a + b, 2) * (a + b + 1)))
    standing = near.select("host", F.when(bound > over, "block").otherwise("allow").alias("standing"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return urls.join(standing, "host", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.col("standing"), F.lit("allow")).alias("verdict"))


def page_outcomes(labels: DataFrame) -> DataFrame:
    """Outcomes from the table of labels, whose ids name the page a text was taken from: bad is low quality or toxic."""
    return labels.select(F.col("doc_id").alias("page_id"), F.greatest(1 - F.col("quality"), F.col("toxic")).cast("int").alias("bad"))


def op9_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"), page_outcomes(table(spark, sf_dir, "labels")))


_UNDER = "select c.*, p.a / (p.a + p.b) as m from {counts} c join {parent} p on c.{up} = p.{up}"
_PARENT = """
{name}_in as ({counts}),
{name}_fit as (select case when e1 - e0 > 0 then (v - e0) / (e1 - e0) end as r from (
    select sum(n * power(bad / n - m, 2)) as v, sum(m * (1 - m)) as e0, sum(n * m * (1 - m)) as e1 from {name}_in where n >= 2)),
{name} as (select {key}, s * m + bad as a, s * (1 - m) + n - bad as b from {name}_in, (
    select coalesce(case when r <= 1.0 / 201 then 200.0 when r >= 0.5 then 1.0 else 1 / r - 1 end, 200.0)::double as s from {name}_fit))"""

OP9_SQL = rf"""
with urls as (
  select page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
marks as (select doc_id as page_id, max(greatest(1 - quality, toxic)) as bad from labels where doc_id is not null and quality is not null and toxic is not null group by 1),
labelled as (select host, count(*)::double as n, sum(bad)::double as bad from urls join marks using (page_id) group by 1),
bare as (select host, regexp_replace(regexp_replace(host, '^.*@|:[0-9]*$', '', 'g'), '\.+$', '') as name from (select distinct host from urls)),
names as (select host, name, regexp_matches(name, '{ADDRESS}') as number, string_split(name, '.') as p from bare),
split as (select host, name, number, regexp_matches(array_to_string(p[-2:], '.'), '^({'|'.join(SECOND_LEVELS)})\.[a-z]{{2}}$') as double, array_to_string(p[-2:], '.') as two, array_to_string(p[-3:], '.') as three, coalesce(p[-1], '') as one from names),
hosts as (select s.host, n, bad, case when number then 'ip' when double then two else one end as suffix, case when number then name when double then three else two end as domain
          from split s left join labelled l on s.host = l.host),
known as (select * from hosts where n is not null),
suffixes as (select suffix, sum(n) as n, sum(bad) as bad, (select (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) from known) as m from known group by suffix),
domains as (select suffix, domain, sum(n) as n, sum(bad) as bad from known group by all),
{_PARENT.format(name="by_suffix", counts="select * from suffixes", key="suffix")},
{_PARENT.format(name="by_domain", counts=_UNDER.format(counts="domains", parent="by_suffix", up="suffix"), key="domain")},
{_PARENT.format(name="by_host", counts=_UNDER.format(counts="known", parent="by_domain", up="domain"), key="host")},
near as (select h.host, coalesce(x.a, y.a, z.a) as a, coalesce(x.b, y.b, z.b) as b from hosts h
         left join by_host x on h.host = x.host left join by_domain y on h.domain = y.domain left join by_suffix z on h.suffix = z.suffix),
standing as (select host, case when a / (a + b) - 1.645 * sqrt(a * b / (power(a + b, 2) * (a + b + 1))) > 0.5 then 'block' else 'allow' end as standing from near),
fits as (
  select u.*, case
    when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
    when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/' end as rule from urls u)
select page_id, f.host, path, rule, case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block' else standing end as verdict
from fits f join standing s on f.host = s.host
"""
