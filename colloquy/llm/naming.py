"""Which video a row of `videos` names: by vid, failing that by the address its url leads to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_ID = r"[A-Za-z0-9_-]{11}"
_SPACE = r"^[\s ]+|[\s ]+$"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with value evaluated once: a column used twice would be expanded twice in the plan."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _found(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def _trim(text: Column) -> Column:
    return F.regexp_replace(text, _SPACE, "")


def _decoded(text: Column) -> Column:
    return _let(text, lambda t: F.coalesce(F.try_url_decode(t), t))


def _onward(url: Column) -> Column:
    """The address inside a redirect address, else the address itself."""
    return F.coalesce(F.try_url_decode(_found(url, r"(?i)^[^?#]*/redirect/?\?(?:[^#]*&)?(?:q|url|u)=([^&#]+)")), url)


def _address(url: Column, then: Callable[[Column], Column]) -> Column:
    """then(address): trimmed, with & for its HTML spelling, led through redirect addresses (twice at most)."""
    return _let(F.regexp_replace(_trim(url), "(?i)&amp;", "&"), lambda u: _let(_onward(u), lambda v: _let(_onward(v), then)))


def _address_id(url: Column) -> Column:
    param = _decoded(_found(url, r"^[^?#]*\?(?:[^#]*?&)?v=([^&#]*)"))
    path = _decoded(_found(url, r"(?i)^(?:[a-z]+://)?[^/?#\s]+\.[^/?#\s]+/(?:(?:embed|live|shorts|v|e)/)?([^/?#]+)(?:[/?#]|$)"))
    return F.coalesce(*[_found(_trim(x), rf"^({_ID})$") for x in (param, path)])


def video_id(vid: Column, url: Column) -> Column:
    """The 11-character id, case kept; null where neither column has one. Ids in other parameters do not count."""
    own = _let(_trim(vid), lambda v: _found(v, rf"^(?:.*[:/=])?({_ID})/?$"))
    return F.coalesce(own, _address(vid, _address_id), _address(url, _address_id))


def talk_words(url: Column) -> Column:
    """The words and numbers after /talks/ in lower case, in order; null where the address has none."""
    slug = _address(url, lambda u: _found(u, r"(?i)^[^?#]*/talks/([^?#]*)"))
    words = F.filter(F.split(F.lower(_decoded(slug)), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")
    return _let(words, lambda w: F.when(F.size(w) > 0, w))
