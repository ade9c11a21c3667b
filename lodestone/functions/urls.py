"""URL reference resolution (RFC 3986, section 5) as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# The splitting pattern of RFC 3986, appendix B.
_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _URL, 1))


def url_authority(url: Column) -> Column:
    """Host with port and user info, as written."""
    return F.regexp_extract(url, _URL, 3)


def _drop_dots(path: Column) -> Column:
    start = F.array().cast("array<string>")

    def step(acc: Column, seg: Column) -> Column:
        up = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
        return F.when(seg == "..", up).when(seg == ".", acc).otherwise(F.concat(acc, F.array(seg)))

    def resolve(p: Column) -> Column:
        kept = F.array_join(F.aggregate(F.split(p, "/"), start, step), "/")
        kept = F.when(p.rlike(r"/\.\.?$"), F.concat(kept, F.lit("/"))).otherwise(kept)
        rooted = let(kept, lambda k: F.when(k.startswith("/"), k).otherwise(F.concat(F.lit("/"), k)))
        return F.when(p.rlike(r"(^|/)\.\.?(/|$)"), rooted).otherwise(p)

    return let(path, resolve)


def resolve_url(base: Column, ref: Column) -> Column:
    """Absolute form of ``ref`` seen from the page ``base``; an empty reference is the page itself."""
    ref = F.regexp_replace(ref, r"^[\x00-\x20]+|[\t\r\n]+", "")
    parsed = F.array(*[F.regexp_extract(u, _URL, i) for u in (base, ref) for i in range(1, 7)])

    def join(p: Column) -> Column:
        base_scheme, base_net, _, base_path, base_query, _ = (p[i] for i in range(6))
        scheme, net, _, path, query, fragment = (p[i] for i in range(6, 12))
        scheme, base_scheme = F.lower(scheme), F.lower(base_scheme)
        query = F.when(query != "?", query).otherwise("")
        fragment = F.when(fragment != "#", fragment).otherwise("")
        folder = F.concat(F.regexp_replace(base_path, r"[^/]*$", ""), F.when(base_path == "", "/").otherwise(""))
        beside = F.regexp_replace(F.concat(folder, path), "/{2,}", "/")
        target = _drop_dots(F.when(path.startswith("/"), path).otherwise(beside))
        query_or_base = F.when(query != "", query).otherwise(F.when(base_query != "?", base_query).otherwise(""))
        tail = F.when(path == "", F.concat(base_path, query_or_base)).otherwise(F.concat(target, query))
        return (
            F.when((scheme != "") & (scheme != base_scheme), ref)
            .when(net != "", F.concat(base_scheme, F.lit(":"), net, path, query, fragment))
            .otherwise(F.concat(base_scheme, F.lit(":"), base_net, tail, fragment))
        )

    return F.when(ref == "", base).otherwise(let(parsed, join))
