"""Plain words and sentences of a text."""

from __future__ import annotations

import html
import re
import unicodedata

# Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(
    zip(
        "АВЕКМНОРСТУХаеорсухіјѕԁһӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανρικτυχγωɑɡıⅼ",
        "ABEKMHOPCTYXaeopcyxijsdhlABEZHIKMNOPTYXoavpiktuxywagil",
    )
)
_MARK = re.compile(r"<[^<>]{0,80}>|&[a-z#0-9]{1,8};?|[*_`~]+")
_INNER = re.compile(r"(?<=\d)[ ,.'’](?=\d{3}(?!\d))")
_WORD = re.compile(r"[a-z0-9]+")
_STAMP = re.compile(r"^\s*(?:#+|>+|\[\d\d?:\d\d\]|- )+\s*", re.M)
_MAY_MARK = re.compile(r"[#>\[<&*_`~-]")
_HYPHEN = re.compile(r"(?<=[A-Za-z])-\s*\n\s*(?=[a-z])")


def words(text: str) -> list[str]:
    """Plain words of a text: lower-case letters and digits, whatever its markup, number style, script tricks or spacing."""
    t = html.unescape(text) if "&" in text else text
    if _MAY_MARK.search(t):
        t = _STAMP.sub(" ", t)
        t = _MARK.sub(lambda m: " " if m[0][0] in "<&" else "", t)
    if not t.isascii():
        t = _plain_letters(t)
    t = t.lower()
    if "-" in t and "\n" in t:
        t = _HYPHEN.sub("", t)
    while _INNER.search(t):
        t = _INNER.sub("", t)
    return _WORD.findall(t)


class _Letters(dict):
    """Translation table that fills itself: invisible characters go, look-alikes become Latin."""

    def __missing__(self, code: int) -> str | None:
        c = chr(code)
        out = self[code] = None if unicodedata.category(c) in ("Cf", "Cc") and c not in "\n\t\r" else LOOKALIKES.get(c, c)
        return out


class _Bare(dict):
    """Translation table that fills itself: combining marks go."""

    def __missing__(self, code: int) -> int | None:
        out = self[code] = None if unicodedata.combining(chr(code)) else code
        return out


_LETTERS, _BARE = _Letters(), _Bare()


def _plain_letters(t: str) -> str:
    t = unicodedata.normalize("NFKC", t).translate(_LETTERS)
    return unicodedata.normalize("NFKD", t).translate(_BARE)


_SENTENCE = re.compile(r"""(?<=[.!?])["')\]]*\s+|\n+""")


def sentences(text: str) -> list[list[str]]:
    """Sentences of three words or more, as plain words."""
    return [w for s in _SENTENCE.split(text) if len(w := words(s)) >= 3]
