"""URL host and registrable domain as regular expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import col_of

HOST_NULL = "HOST_NULL"

# The public suffixes of the domain rule, and its IPv4 pattern.
PUBLIC_SUFFIXES = (
    "com", "org", "net", "gov", "edu", "co", "tv", "mobi", "info", "asia", "xxx", "onion",
    "cn", "com.cn", "edu.cn", "gov.cn", "net.cn", "org.cn", "jp", "kr", "tw",
    "com.hk", "hk", "org.hk", "se", "com.se", "org.se",
)
IPV4_PATTERN = r"^([0-9]{1,3}\.){3}[0-9]{1,3}$"

_AUTHORITY = r"(?:[^/?#]*@)?(\[[^\]]*\]|[^/?#:]*)(?::[0-9]*)?(?:[/?#].*)?"
URL_PATTERN = r"(?is)^[\x00-\x20]*(?:https?|ftp|file):(?://" + _AUTHORITY + r"|(?:[^/]|/[^/]).*|/?)$"

_SUFFIX_ALTERNATIVES = "|".join(s.replace(".", r"\.") for s in PUBLIC_SUFFIXES)
DOMAIN_PATTERN = rf"^(?:[^.]*\.)*?([^.]*\.(?:{_SUFFIX_ALTERNATIVES}))$"


def url_host(c: Column | str) -> Column:
    """Host part of a URL, case kept; null when the text is not a usable URL."""
    c = col_of(c)
    return F.when(c.rlike(URL_PATTERN), F.regexp_extract(c, URL_PATTERN, 1))


def host_domain(host: Column | str) -> Column:
    """The shortest cut of the host that starts one label before a known suffix.

    The leftmost cut whose remainder is a known suffix wins. An unknown suffix gives the
    last label alone, an IPv4 address is returned as it is, one final dot is ignored.
    """
    host = F.regexp_replace(col_of(host), r"\.$", "")
    known = F.regexp_extract(host, DOMAIN_PATTERN, 1)
    return (
        F.when(host.rlike(IPV4_PATTERN), host)
        .when(known != "", known)
        .otherwise(F.substring_index(host, ".", -1))
    )


def url_domain(c: Column | str) -> Column:
    return host_domain(url_host(c))
