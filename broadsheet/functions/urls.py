"""URL, identity and hash columns. All are built-in expressions; malformed input gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: query parameters that track visits, and host labels that name a service
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "mc_eid", "mc_cid", "ref", "yclid", "dclid", "irwid", "wbraid")
SERVICE_LABELS = ("www", "blog", "news", "dev", "docs")
FEED_ENDINGS = (".rss", ".xml", ".atom", ".rdf", ".rss2")
FEED_PATHS = ("/feed", "/rss", "/atom")
# end of fixed values

_URL = r"^([A-Za-z][A-Za-z0-9+.-]*):(?://(?:[^/?#@]*@)?(\[[^\]]*\]|[^:/?#]*)(?::(\d*))?)?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.trim(url), _URL, group)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def host(url: Column) -> Column:
    """The host in lower case, '' where there is none."""
    return F.lower(_part(url, 2))


def path(url: Column) -> Column:
    return _part(url, 4)


def normalize_domain(url: Column) -> Column:
    """The host without any leading w and dot characters; the host itself where nothing would be left."""
    stripped = F.ltrim(host(url), F.lit("w."))
    return F.when(stripped == "", host(url)).otherwise(stripped)


def service_domain(url: Column) -> Column:
    """The host without a first label such as www or blog."""
    return F.regexp_replace(host(url), rf"^({'|'.join(SERVICE_LABELS)})\.", "")


def canonical_simple(url: Column) -> Column:
    """Lower case, no fragment, no slash at the path's end (the root keeps its own)."""
    low = F.regexp_replace(F.lower(F.trim(url)), "#.*$", "")
    bare = F.regexp_replace(low, r"/+(\?.*)?$", "$1")
    return F.regexp_replace(bare, r"^([a-z][a-z0-9+.-]*://[^/?]+)(\?.*)?$", "$1/$2")


def canonical(url: Column) -> Column:
    """Scheme and host lower-cased, default ports, user, tracking parameters, fragment and .git dropped, the first value of a key kept."""
    port = _part(url, 3)
    usual = ((scheme(url) == "http") & (port == "80")) | ((scheme(url) == "https") & (port == "443"))
    authority = F.concat(host(url), F.when((port == "") | usual, F.lit("")).otherwise(F.concat(F.lit(":"), port)))
    bare = F.regexp_replace(F.lower(path(url)), "/+$", "")
    whole = F.regexp_replace(F.when(bare == "", F.lit("/")).otherwise(bare), r"\.git$", "")
    clean = F.when(whole == "", F.lit("/")).otherwise(whole)
    pairs = F.filter(F.split(_part(url, 5), "&"), lambda p: (p != "") & ~F.split(p, "=", 2)[0].isin(*TRACKING))
    keys = F.transform(pairs, lambda p: F.split(p, "=", 2)[0])
    firsts = F.filter(pairs, lambda p, i: F.array_position(keys, F.split(p, "=", 2)[0]) == i + 1)
    query = F.array_join(F.transform(firsts, lambda p: F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("=")))), "&")
    made = F.concat(scheme(url), F.lit("://"), authority, clean, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))
    return F.when(F.trim(url) == "", F.lit("")).when(scheme(url) == "", F.lower(F.trim(url))).otherwise(made)


def source_id(kind: Column, url: Column, owner: Column | None = None, repo: Column | None = None, subtype: Column | None = None, query: Column | None = None) -> Column:
    """A source's id by its kind: trending or owner/repo, a hash of the query, else the domain (with the last path part for paper archives)."""
    none = F.lit(None).cast("string")
    owner, repo, subtype, query = (none if x is None else x for x in (owner, repo, subtype, query))
    domain = normalize_domain(url)
    last = F.element_at(F.split(F.regexp_replace(path(url), "/+$", ""), "/"), -1)
    words = F.lower(F.trim(F.coalesce(query, F.lit(""))))
    archive = domain.endswith("arxiv.org") & kind.isin("rss", "web", "arxiv") & (last != "")
    return (
        F.when((kind == "github") & (F.coalesce(subtype, F.lit("")) == "github_trending"), F.lit("github:trending"))
        .when(kind == "github", F.concat(F.lit("github:"), F.coalesce(owner, F.lit("unknown")), F.lit("/"), F.coalesce(repo, F.lit("unknown"))))
        .when(kind == "exa_search", F.concat(F.lit("exa_search:"), F.when(words == "", F.lit("empty")).otherwise(F.left(F.md5(words), F.lit(8)))))
        .when(archive, F.concat_ws(":", kind, domain, last))
        .otherwise(F.concat_ws(":", kind, domain))
    )


def source_type(url: Column) -> Column:
    """github_repo, github_trending, arxiv, atom, rss or web, the first rule that holds; NULL for what is no web address."""
    u, h, p = F.trim(url), host(url), F.lower(path(url))
    bare = F.regexp_replace(p, "/+$", "")
    ends = [p.endswith(e) | bare.endswith(e) for e in FEED_ENDINGS]
    feed = ends[0]
    for e in ends[1:]:
        feed = feed | e
    inside = F.contains(p, F.lit(FEED_PATHS[0]))
    for e in FEED_PATHS[1:]:
        inside = inside | F.contains(p, F.lit(e))
    return (
        F.when(~scheme(url).isin("http", "https") | (h == ""), F.lit(None).cast("string"))
        .when(u.rlike(r"(?i)^https?://(www\.)?github\.com/trending"), F.when(u.rlike(r"(?i)^https?://(www\.)?github\.com/[^/]+/[^/]+$"), F.lit("github_repo")).otherwise(F.lit("github_trending")))
        .when(u.rlike(r"(?i)^https?://(www\.)?github\.com/[^/]+/[^/]+$"), F.lit("github_repo"))
        .when(h == "rss.arxiv.org", F.lit("arxiv"))
        .when((h == "arxiv.org") & u.rlike(r"(?i)^https?://arxiv\.org/abs/\d+\.\d+$"), F.lit("web"))
        .when(feed, F.when(F.contains(p, F.lit(".atom")), F.lit("atom")).otherwise(F.lit("rss")))
        .when(inside, F.lit("rss"))
        .otherwise(F.lit("web"))
    )


def resolve(url: Column) -> Column:
    """struct(canonical_url, source_type, connector, confidence, reason); the type is NULL and the reason tells why where none fits."""
    kind, u = source_type(url), F.trim(url)
    repo = F.regexp_extract(u, r"(?i)^https?://(?:www\.)?github\.com/([^/]+)/([^/]+?)(?:\.git)?$", 1)
    name = F.regexp_extract(u, r"(?i)^https?://(?:www\.)?github\.com/([^/]+)/([^/]+?)(?:\.git)?$", 2)
    address = F.when(kind == "github_repo", F.lower(F.concat(F.lit("https://github.com/"), repo, F.lit("/"), name))).when(kind == "github_trending", F.lit("https://github.com/trending")).otherwise(canonical(url))
    connector = F.when(kind.isin("github_repo", "github_trending"), F.lit("github")).when(kind.isin("rss", "atom"), F.lit("rss")).otherwise(kind)
    by_path = ~F.lower(path(url)).rlike(r"\.(rss|xml|atom|rdf|rss2)/*$")
    confidence = F.when(kind.isin("github_repo", "github_trending", "arxiv"), F.lit(1.0)).when(kind.isin("rss", "atom"), F.when(by_path, F.lit(0.8)).otherwise(F.lit(0.9))).when(kind == "web", F.lit(0.5))
    reason = F.when(F.coalesce(u, F.lit("")) == "", F.lit("empty")).when(~scheme(url).isin("http", "https"), F.lit("scheme")).when(host(url) == "", F.lit("host"))
    return F.struct(address.alias("canonical_url"), kind.alias("source_type"), connector.alias("connector"), confidence.alias("confidence"), reason.alias("reason"))


# ---- identities ------------------------------------------------------------------------------------
def content_hash(url: Column, title: Column, summary: Column) -> Column:
    return F.left(F.sha2(F.concat(url, F.lit("||"), title, F.lit("||"), F.coalesce(summary, F.lit(""))), 256), F.lit(16))


def article_id(url: Column) -> Column:
    return F.left(F.sha2(url, 256), F.lit(16))


def event_id(week: Column, category: Column, title: Column) -> Column:
    return F.concat(F.lit("evt_"), F.left(F.sha2(F.concat_ws("|", week, category, F.trim(title)), 256), F.lit(12)))


def report_id(week: Column) -> Column:
    return F.concat(F.lit("rpt_"), F.replace(week, F.lit("-"), F.lit("")))


def dedup_key(url: Column, bucket: Column) -> Column:
    return F.md5(F.concat_ws(":", url, bucket))


def request_key(method: Column, url: Column) -> Column:
    return F.left(F.md5(F.concat_ws(":", method, url)), F.lit(16))


def found_urls(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("https?://[^\\s<>\"')\\]]+"), F.lit(0))


def sanitize_url(url: Column) -> Column:
    bare = F.trim(url)
    return F.when(bare == "", F.lit(None).cast("string")).when(bare.rlike("^https?://"), bare).otherwise(F.concat(F.lit("https://"), bare))
