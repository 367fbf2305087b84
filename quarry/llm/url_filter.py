"""URL filtering with redirect equivalence.

Explicit rules (host and subdomains, path prefix, longest wins) judge an url first.  Pages
that name another url as their canonical address, or redirect to it, are aliases of it:
the components of that graph are found on the cluster, and an url without a rule of its
own is blocked if any url of its component is blocked by a rule.  An explicit allow always
takes precedence: it holds for its url, whatever the component says, and never spreads.

Defined cases: a null url, or one without ``://``, has an empty host and path, meets no
rule and is allowed; null or empty html has no links; repeated rows are judged alike; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved
from quarry.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[Rule], what: str) -> Column:
    """``what`` (``name`` or ``verdict``) of the winning rule, null if none: the longest
    host and path, allow on a tie."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "allow")):  # the last that matches wins
        hit = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found = F.when(hit, F.lit(getattr(r, what))).otherwise(found)
    return found


def node_key(url: Column) -> Column:
    """One spelling per address: host in lower case, the rest up to a fragment; the scheme is left out."""
    rest = F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*([^#]*)", 1)
    return F.concat(host_of(url), F.when((rest == "") | (rest == "/"), F.lit("/")).otherwise(rest))


def without_dots(path: Column) -> Column:
    """A path from ``/`` on without its ``.`` and ``..`` segments."""
    parts = F.split(F.substring(path, F.lit(2), F.length(path)), "/")
    step = lambda kept, x: F.when(x == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).when(x == ".", kept).otherwise(F.concat(kept, F.array(x)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    last = F.element_at(parts, -1)
    return F.concat(F.lit("/"), F.array_join(F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/"))


def resolved(url: Column, dst: Column) -> Column:
    """The address of a link on the page ``url``; null where it has none: another kind of
    scheme, or a relative link on a page without a host."""
    scheme, host = F.regexp_extract(url, r"^([^:/]*):", 1), host_of(url)
    path, own = F.regexp_extract(dst, r"^([^?#]*)", 1), path_of(url)
    rest = F.substring(dst, F.length(path) + F.lit(1), F.length(dst))
    folder = F.concat(F.lit("/"), F.regexp_extract(own, r"^/(.*/)?", 1))
    origin = F.concat(scheme, F.lit("://"), host)
    return (F.when(F.regexp_like(dst, F.lit(r"^[a-zA-Z][a-zA-Z0-9+.-]*://")), dst)
            .when(F.regexp_like(dst, F.lit(r"^[a-zA-Z][a-zA-Z0-9+.-]*:")) | (host == ""), F.lit(None))
            .when(F.startswith(dst, F.lit("//")), F.concat(scheme, F.lit(":"), dst))
            .when(path == "", F.concat(origin, F.when(own == "", F.lit("/")).otherwise(own), rest))
            .when(F.startswith(dst, F.lit("/")), F.concat(origin, without_dots(path), rest))
            .otherwise(F.concat(origin, without_dots(F.concat(folder, path)), rest)))


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value by its own quotes, without blanks around it, entities decoded."""
    value = rf"(?is)(?<![\w-]){name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    return decoded(F.btrim(F.concat(*[F.coalesce(F.regexp_extract(tag, value, i), F.lit("")) for i in (1, 2, 3)]), F.lit(" \t\r\n\f")))


def decoded(text: Column) -> Column:
    """``text`` with numeric and the five predefined entities replaced."""
    hexed = lambda p: F.regexp_like(p, F.lit(r"^[xX][0-9a-fA-F]{1,6};"))
    digits = lambda p: F.regexp_extract(p, r"^[xX]?([0-9a-fA-F]+);", 1)
    code = lambda p: F.when(hexed(p), F.conv(digits(p), 16, 16)).otherwise(F.conv(digits(p), 10, 16))
    known = lambda p: hexed(p) | F.regexp_like(p, F.lit(r"^[0-9]{1,7};"))
    as_text = lambda p: F.decode(F.unhex(F.lpad(code(p), 8, "0")), "UTF-32")
    valid = lambda p: known(p) & (F.conv(code(p), 16, 10).cast("int") < 0xD800)
    one = lambda p: F.when(valid(p), F.concat(as_text(p), F.regexp_extract(p, r"(?s)^[^;]*;(.*)", 1))).otherwise(F.concat(F.lit("&#"), p))
    parts = F.split(text, "&#")
    out = F.when(F.instr(text, "&#") == 0, text).otherwise(F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), one), "")))
    for name, sign in (("quot", '"'), ("apos", "'"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        out = F.replace(out, F.lit(f"&{name};"), F.lit(sign))
    return out


def page_links(pages: DataFrame) -> DataFrame:
    """``(src, dst)`` urls: all canonical links and immediate redirects of each page's html,
    resolved against the page's url or the first base that it names."""
    rel = r"(?is)(?<![\w-])rel\s*=\s*(?:\"(?:[^\"]*\s)?canonical(?:\s[^\"]*)?\"|'(?:[^']*\s)?canonical(?:\s[^']*)?'|canonical(?=[\s/>]))"
    equiv = r"(?is)(?<![\w-])http-equiv\s*=\s*[\"']?\s*refresh\b"
    # a tag ends at a > outside quotes, or at the first one where its quotes don't match
    tag = lambda name: rf"(?is)<{name}\b(?:(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*>)"
    named = attribute(F.regexp_extract("html", tag("base"), 0), "href")
    found = pages.select("url", "html").where("url is not null and html is not null").withColumn("base", F.when(named == "", F.col("url")).otherwise(F.coalesce(resolved(F.col("url"), named), F.col("url"))))

    def tags(name: str, which: str, target: Column) -> DataFrame:
        all_ = found.select("url", "base", F.explode(F.regexp_extract_all("html", F.lit(tag(name)), F.lit(0))).alias("tag"))
        return all_.where(F.regexp_like("tag", F.lit(which))).select("url", "base", target.alias("dst"))

    goal = F.regexp_extract(attribute(F.col("tag"), "content"), r"(?is)\burl\s*=\s*(?:\"([^\"]*)|'([^']*)|([^\s\"']+))", 0)
    goal = F.btrim(F.regexp_replace(goal, r"(?is)^url\s*=\s*[\"']?", ""), F.lit(" \t\r\n\f"))
    links = tags("link", rel, attribute(F.col("tag"), "href")).unionByName(tags("meta", equiv, goal))
    return links.where("dst <> ''").select(F.col("url").alias("src"), resolved(F.col("base"), F.col("dst")).alias("dst")).where("dst is not null")


def judge(pages: DataFrame, rules: list[Rule], links: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, component``.  ``links(src, dst)`` are further
    redirects between urls, such as a crawl log's."""
    edges = page_links(pages)
    if links is not None:
        edges = edges.unionByName(links.select("src", "dst").where("src is not null and dst is not null"))
    addresses = saved(edges.select(node_key(F.col("src")).alias("src"), node_key(F.col("dst")).alias("dst")).where("src <> dst").distinct())
    comps = connected_components(addresses.select(F.xxhash64("src").alias("u"), F.xxhash64("dst").alias("v")))
    urls = pages.select("page_id", "url").select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules, "name")).withColumn("own", matching_rule(F.col("host"), F.col("path"), rules, "verdict"))
    urls = urls.withColumn("node", F.xxhash64(node_key(F.col("url"))))
    # a component is blocked by any blocked address in it, crawled or only linked to
    ends = addresses.select(F.explode(F.array("src", "dst")).alias("key")).distinct()
    ends = ends.select(F.xxhash64("key").alias("node"), F.regexp_extract("key", r"^([^/?]*)", 1).alias("h"), F.regexp_extract("key", r"^[^/?]*([^?]*)", 1).alias("p"))
    ends = ends.withColumn("own", matching_rule(F.col("h"), F.col("p"), rules, "verdict"))
    blocked = comps.join(ends.select("node", "own"), "node").groupBy("component").agg(F.max((F.col("own") == "block").cast("int")).alias("bad"))
    states = comps.join(blocked, "component").select("node", "component", F.coalesce("bad", F.lit(0)).alias("bad"))
    verdict = F.when(F.col("own").isNotNull(), F.col("own")).when(F.col("bad") == 1, F.lit("block")).otherwise(F.lit("allow"))
    return urls.join(states, "node", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "component")
