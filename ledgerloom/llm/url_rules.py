"""URL filtering with rules indexed by their rarest literal token (operator 5). DataFrame functions only.

A rule is a regular expression over ``host + path`` with literal tokens that every match contains. Tokens are letters and
digits between separators. Counting how often the rules' tokens occur in all urls picks each rule's rarest one; a url's tokens then
fetch the rules filed under them, and only those rules are tried. Work grows with urls times their tokens, not with
the number of rules. Rules without a literal token stand in a second list, one value of the query, and every one of them is tried on
every url. Hosts and paths are written once; counting, fetching and trying read what was written.

Rows: a null url, or one without ``://``, has an empty host and path and gets the default verdict; empty hosts match no
rule; repeated urls are judged once and joined back; extra columns are ignored; an empty table gives no rows. Rules are ordered:
listed rules (host and path) before patterns, then the longest, then the smaller name.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialize

#: The rules that the contract lists: host, path, verdict.
LISTED = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Words whose presence as whole tokens of the host, in this order, marks unwanted sites.
UNWANTED = ["adult-dating", "betting", "casino", "casinos", "cheap-pills", "free-money", "gambling", "lottery", "online-pharmacy",
            "payday-loans", "poker", "porn", "porno", "replica-watches", "torrent", "torrents", "viagra", "warez", "xxx"]
#: Ports, scripts, links of a visit and downloads that hold no text to learn from, besides hosts that are plain addresses.
PORTS = [8080, 8443, 8888]
SCRIPTS = ["wp-login.php", "xmlrpc.php", "wp-admin", "cgi-bin"]
VISITS = ["jsessionid", "phpsessid"]
DOWNLOADS = ["apk", "exe", "iso", "msi", "rar", "tar.gz", "zip"]
ADDRESS = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}(:[0-9]+)?(/|$)"
DEFAULT = "allow"
_SEPARATORS = "[^0-9A-Za-z]+"


def listed_rule(host: str, path: str, verdict: str) -> tuple:
    """The host and its subdomains, paths that start with ``path``."""
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    inner = path.rsplit("/", 1)[0]  # a token at the open end of the path may go on in the url
    return (host + path, pattern, [t for t in re.split(_SEPARATORS, host + inner) if t], verdict, 1, len(host + path))


def word_rule(word: str) -> tuple:
    pattern = rf"^[^/]*(?<![0-9A-Za-z]){re.escape(word)}(?![0-9A-Za-z])[^/]*(?:/|$)"
    return (word, pattern, re.split(_SEPARATORS, word), "block", 0, len(word))


def pattern_rule(name: str, pattern: str, literal: str = "") -> tuple:
    """A rule that blocks; every match holds the tokens of ``literal`` whole."""
    return (name, pattern, [t for t in re.split(_SEPARATORS, literal) if t], "block", 0, len(name))


def place_rules() -> list[tuple]:
    """Rules on addresses, ports and paths; paths are compared with their case."""
    return [pattern_rule("address", ADDRESS),
            *(pattern_rule(f"port {p}", rf"^[^/]*:{p}(/|$)", str(p)) for p in PORTS),
            *(pattern_rule(f"script {s}", rf"^[^/]*/(.*/)?{re.escape(s)}(/|$)", s) for s in SCRIPTS),
            *(pattern_rule(f"visit {v}", rf"^[^/]*/.*[^0-9A-Za-z]{v}=", v) for v in VISITS),
            *(pattern_rule(f"download {d}", rf"^[^/]*/.*\.{re.escape(d)}$", d) for d in DOWNLOADS)]


def rule_table(spark, listed=tuple(LISTED), words=tuple(UNWANTED), patterns: tuple | None = None) -> DataFrame:
    """The listed rules, those on words of the host, and ``patterns`` (as ``pattern_rule`` makes them; ``place_rules`` unless given)."""
    rows = [listed_rule(*r) for r in listed] + [word_rule(w) for w in words] + list(place_rules() if patterns is None else patterns)
    return spark.createDataFrame(rows, "name string, pattern string, literals array<string>, verdict string, listed int, width int")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parse(url: Column) -> dict[str, Column]:
    """Host (lower-cased A-Z) and path, both empty without ``://``."""
    found = F.instr(url, "://")
    rest = F.when(found > 0, F.substr(url, found + F.lit(3))).otherwise(F.lit(""))
    return {"host": lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)}


def indexed(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """The rules with literals, each under the one of them that is rarest among ``tokens`` (token), ties by name."""
    literals = rules.select("name", F.explode("literals").alias("token"))
    wanted = materialize(literals.select("token").distinct(), "rule-tokens")  # of known size, like the index
    counts = tokens.join(wanted, "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    rarest = (literals.join(counts, "token", "left")
              .groupBy("name").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("rarest")))
    return rules.join(rarest, "name").select(F.col("rarest.token").alias("token"), "name", "pattern", "verdict", "listed", "width")


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict, reason) of every row of ``pages`` (page_id, url).

    ``rule`` names a listed rule only; ``reason`` names any rule that decided.
    """
    parsed = pages.select("page_id", *(c.alias(n) for n, c in parse(F.col("url")).items()))
    places = materialize(parsed.where("host <> ''").select("host", "path").distinct(), "places")
    tokens = places.select("host", "path", F.explode(F.array_distinct(F.split(F.concat("host", F.lit("/"), "path"), _SEPARATORS))).alias("token"))
    rules = rules.withColumn("literals", F.filter("literals", lambda t: t != ""))  # what a split leaves beside non-ASCII letters is no token
    # Written, so that Spark knows its size before it plans the join: a list below its broadcast threshold comes to the tokens, which stay.
    by_token = materialize(indexed(rules, tokens.select("token")), "rules-by-token")
    fetched = tokens.join(by_token, "token").drop("token")
    matches = F.expr("regexp_like(concat(host, path), pattern)")
    kept = ("name", "pattern", "verdict", "listed", "width")
    # One value for the whole query: as many rules as a user lists without any literal token.
    everywhere = rules.where(F.coalesce(F.size("literals"), F.lit(0)) <= 0).agg(F.collect_list(F.struct(*kept))).scalar()
    open_rules = places.withColumn("rules", everywhere).select("host", "path", F.inline("rules"))
    tried = fetched.where(matches).unionByName(open_rules.where(matches))
    best = tried.groupBy("host", "path").agg(F.max_by(F.struct("name", "verdict", "listed"), F.struct("listed", "width", "name")).alias("best"))
    return parsed.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.when(F.col("best.listed") == 1, F.col("best.name")).alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"), F.col("best.name").alias("reason"))


ORACLE = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM parsed)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host, '(^|[^0-9a-z])({"|".join(UNWANTED)})([^0-9a-z]|$)') THEN 'block'
    WHEN regexp_matches(host, '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}(:[0-9]+)?$') THEN 'block'
    WHEN regexp_matches(host, ':({"|".join(map(str, PORTS))})$') THEN 'block'
    WHEN regexp_matches(path, '/({"|".join(s.replace(".", "[.]") for s in SCRIPTS)})(/|$)') THEN 'block'
    WHEN regexp_matches(path, '/.*[^0-9A-Za-z]({"|".join(VISITS)})=') THEN 'block'
    WHEN regexp_matches(path, '[.]({"|".join(d.replace(".", "[.]") for d in DOWNLOADS)})$') THEN 'block' ELSE '{DEFAULT}' END AS verdict
FROM ruled
"""
