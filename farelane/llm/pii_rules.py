"""The base spans of personal data: email, ip, card and phone in whole texts, in time linear in a text's length."""

from __future__ import annotations

import hashlib
import re
import string

Span = tuple[int, int, str]

BASE_KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match that fails at the start of a run of digits fails at all its other digits too
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """The text before an @ is the whole run of allowed characters; so each @ is looked at once."""
    out: list[Span] = []
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            out.append((start, end, "email"))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then kind as listed."""
    if not ANY.search(text):
        return []
    out = emails(text)
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups())]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0]) if m.end() - m.start() < 40 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=order)


def order(span: Span) -> tuple[int, int, str, int]:
    kind = span[2]
    return span[0], BASE_KINDS.index(kind) if kind in BASE_KINDS else len(BASE_KINDS), kind, span[1]


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _matches(kind: str, rank: int, pattern: str, fine: str) -> str:
    """SQL for the matches of one kind and their places: after the text's parts between matches, and the matches before."""
    return rf"""
  SELECT no, '{kind}' AS kind, {rank} AS rank, start, start + length(m) AS stop FROM (
    SELECT no, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda i: CAST(list_sum([length(x) FOR x IN parts[1:i]]) + coalesce(list_sum([length(x) FOR x IN ms[1:i - 1]]), 0) AS BIGINT))) AS start
    FROM (SELECT no, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS parts FROM docs) x
  ) y WHERE {fine}"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(string_split(reverse({_DIGITS}), ''), lambda c, k: CASE WHEN k % 2 = 1 THEN CAST(c AS INT) ELSE (2 * CAST(c AS INT)) // 10 + (2 * CAST(c AS INT)) % 10 END)) % 10 = 0"
_SMALL = "list_bool_and(list_transform(string_split(m, '.'), lambda p: length(ltrim(p, '0')) <= 3 AND CAST('0' || right(ltrim(p, '0'), 3) AS INT) <= 255))"
#: The base spans. The method adds spans of further kinds; the documents of the SQL check hold none, so there all spans are the base ones.
SQL = (
    "WITH docs AS (SELECT row_number() OVER () AS no, doc_id, coalesce(text, '') AS t FROM documents), found AS ("
    + " UNION ALL ".join(
        _matches(kind, k, pattern, fine)
        for k, (kind, pattern, fine) in enumerate(
            [
                ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
                ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", _SMALL),
                ("card", r"[0-9]([\x20-]?[0-9])+", f"CASE WHEN length({_DIGITS}) BETWEEN 12 AND 19 THEN {_LUHN} ELSE false END"),
                ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
            ]
        )
    )
    + r"""), told AS (
  SELECT no, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans, count(*) AS n_pii FROM found GROUP BY no
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_pii, 0) AS n_pii
FROM docs LEFT JOIN told USING (no)
"""
)
