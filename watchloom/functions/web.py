"""Column expressions over URLs and HTML."""

from __future__ import annotations

import re
from urllib.parse import urljoin, urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the query key that normalising drops.
DROPPED_KEY = "enter_method"


def sanitized(text: Column) -> Column:
    """A file name: no scheme, runs of other characters as one underscore, none at the ends."""
    t = F.regexp_replace(text, r"^https?://", "")
    return F.regexp_replace(F.regexp_replace(t, r"[^a-zA-Z0-9._-]+", "_"), r"^_+|_+\z", "")


def slug(url: Column) -> Column:
    """Path (index if empty), then the query, sanitized."""
    rest = F.regexp_replace(F.regexp_replace(url, r"#.*", ""), r"^[a-z]+://[^/?]*", "")
    path = F.regexp_replace(F.regexp_replace(rest, r"\?.*", ""), r"^/+|/+\z", "")
    query = F.regexp_extract(rest, r"(\?.*)", 1)
    base = F.when(path == "", "index").otherwise(path)
    return sanitized(F.concat(base, F.when(F.length(query) > 1, F.concat(F.lit("_"), sanitized(query))).otherwise("")))


def origin(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([a-zA-Z]+://[^/?#]*)", 1))


def dotless(path: str) -> str:
    """A path without . and .. segments."""
    out: list[str] = []
    parts = path.split("/")
    for part in parts:
        if part == "..":
            out = out[:-1] if len(out) > 1 else out
        elif part != ".":
            out.append(part)
    return "/".join(out) + ("/" if parts[-1] in (".", "..") and out[-1:] != [""] else "")


def resolved(href: str, base: str) -> str | None:
    """href against base as a browser does it, without fragment and the dropped key; null for other schemes or what is no URL.

    Blanks become %20; other characters, and the other pairs of the query, stay as they are written.
    """
    href = re.sub(r"[\t\n\r]", "", href.strip("".join(map(chr, range(0x21))))).replace(" ", "%20")
    try:
        u = urlsplit(urljoin(base, href) if href else base)
        port = u.port
    except ValueError:
        return None
    if u.scheme not in ("http", "https") or not u.hostname:
        return None
    host = u.hostname + (f":{port}" if port not in (None, {"http": 80, "https": 443}[u.scheme]) else "")
    query = "&".join(x for x in u.query.split("&") if x and x.split("=", 1)[0] != DROPPED_KEY)
    return f"{u.scheme}://{host}{dotless(u.path) or '/'}" + (f"?{query}" if query else "")


def within(url: str, origin: str | None = None, prefix: str | None = None) -> bool:
    """Whether a normalised URL has this origin and this prefix."""
    return (origin is None or url == origin or url.startswith(origin.rstrip("/") + "/")) and (prefix is None or url.startswith(prefix))
