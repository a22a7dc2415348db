"""Text functions as columns.

White space is that of Python's ``str``: Java's Unicode class and U+001C to U+001F.
Digits are Unicode digits. Where a rule says "the first pattern that matches", it is
the match that counts, not whether what it captured is empty.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"
DIGIT = r"\p{Nd}"
_UNICODE = "(?U)"

# Words, patterns and lists of the notices this engine reads.
DATE_PATTERNS = (
    (rf"{DIGIT}{{4}}[-./]{DIGIT}{{1,2}}[-./]{DIGIT}{{1,2}}", 0),
    (rf"{DIGIT}{{4}}년{SPACE}*{DIGIT}{{1,2}}월{SPACE}*{DIGIT}{{1,2}}일", 0),
    (rf"{DIGIT}{{1,2}}[-./]{DIGIT}{{1,2}}[-./]{DIGIT}{{4}}", 0),
)
_BREAK = r"[:\s\x1c-\x1f]*"
CASE_PATTERNS = ((rf"{DIGIT}{{4}}[가-힣]+{DIGIT}+", 0), (rf"사건번호{_BREAK}([^\s\x1c-\x1f]+)", 1), (rf"사건{_BREAK}([^\s\x1c-\x1f]+)", 1))
CONTACT_PATTERNS = (*((rf"{word}{_BREAK}([^\n]+)", 1) for word in ("연락처", "전화", "문의", "담당자")), (rf"{DIGIT}{{2,3}}-{DIGIT}{{3,4}}-{DIGIT}{{4}}", 0))
DEADLINE_PATTERNS = tuple((rf"{word}{_BREAK}([^\n]+)", 1) for word in ("마감", "기한", "까지", "신청기간", "접수기간"))
COURT_WORDS = ("법원", "지원", "지청")
FORBIDDEN = '<>:"/\\|?*'
EXTENSIONS = (".pdf", ".doc", ".docx", ".hwp", ".zip", ".xlsx", ".xls")
NAME_LIMIT = 200


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"{_UNICODE}\A{SPACE}+|{SPACE}+\z", "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, rf"{_UNICODE}{SPACE}+", " ")


def clean_text(c: Column) -> Column:
    """Runs of white space become one space, zero-width spaces go afterwards (and may leave two), null becomes empty."""
    return strip(F.replace(collapse(F.coalesce(c, F.lit(""))), F.lit("​"), F.lit("")))


def first_match(c: Column, patterns) -> Column:
    """What the first pattern that matches anywhere captures at its first match; null if none does."""
    out = None
    for pattern, group in patterns:
        pattern = _UNICODE + pattern
        met, found = c.rlike(pattern), F.regexp_extract(c, pattern, group)
        out = F.when(met, found) if out is None else out.when(met, found)
    return out


def notice_date(text: Column) -> Column:
    return F.coalesce(first_match(text, DATE_PATTERNS), F.lit(""))


def case_number(text: Column) -> Column:
    return F.coalesce(first_match(text, CASE_PATTERNS), F.lit(""))


def jurisdiction_line(text: Column) -> Column:
    """The first line with the first of the words that occurs at all."""
    return F.coalesce(strip(first_match(text, [(rf"([^\n]*{w}[^\n]*)", 1) for w in COURT_WORDS])), F.lit(""))


def contact(text: Column) -> Column:
    return F.coalesce(strip(first_match(text, CONTACT_PATTERNS)), F.lit(""))


def deadline(text: Column) -> Column:
    return F.coalesce(strip(first_match(text, DEADLINE_PATTERNS)), F.lit(""))


def extension(name: Column) -> Column:
    """From the last dot on, if something other than dots is before it; else empty."""
    return F.regexp_extract(name, r"(?s)\A\.*[^.].*(\.[^.]*)\z", 1)


def sanitize_filename(name: Column) -> Column:
    """Forbidden characters become ``_``, white space one space; names over 200 characters lose the end of their stem."""
    clean = collapse(strip(F.translate(F.coalesce(name, F.lit("")), FORBIDDEN, "_" * len(FORBIDDEN))))
    ext = extension(clean)
    stem = F.length(clean) - F.length(ext)
    room = F.lit(NAME_LIMIT) - F.length(ext)
    kept = F.when(room >= 0, F.least(room, stem)).otherwise(F.greatest(stem + room, F.lit(0)))
    return F.when(F.length(clean) > NAME_LIMIT, F.concat(F.substr(clean, F.lit(1), kept), ext)).otherwise(clean)


def with_extension(name: Column, file_id: Column) -> Column:
    """A name without a known extension gets that of the file id, or ``.pdf``."""
    known = lambda c: F.array(*[F.lower(c).endswith(e) for e in EXTENSIONS])
    has = F.exists(known(name), lambda x: x)
    own = extension(file_id)
    return F.when(has, name).when(F.coalesce(own, F.lit("")) != "", F.concat(name, own)).otherwise(F.concat(name, F.lit(".pdf")))


def planned_name(index: Column, name: Column, file_id: Column) -> Column:
    """Name under which an attachment is stored: two-digit number, ``_``, clean name with an extension."""
    number = F.when(index < 100, F.lpad(index.cast("string"), 2, "0")).otherwise(index.cast("string"))
    return F.concat(number, F.lit("_"), with_extension(sanitize_filename(name), file_id))


def seq_id(href: Column) -> Column:
    """What follows the first ``seq_id=`` up to ``&``; null without it."""
    return F.when(F.contains(href, F.lit("seq_id=")), F.regexp_extract(href, r"(?s)seq_id=([^&]*)", 1))


def staged_notice_id(stem: Column) -> Column:
    """Digits of ``notice_{digits}__name``; null for other names."""
    return F.nullif(F.regexp_extract(stem, r"\Anotice_([0-9]+)(?:__|\z)", 1), F.lit(""))


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)([^/]*)\z", 1)


def join_url(base: Column, href: Column) -> Column:
    """Links from the root get scheme and host of ``base``; others stay."""
    return F.when(href.startswith("/"), F.concat(F.regexp_extract(base, r"\A([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1), href)).otherwise(href)


def unquote(c: Column) -> Column:
    """Percent-decoding of every valid escape, as UTF-8 with bad bytes replaced; other signs stay, also ``+`` and escapes that are none."""
    lone = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    escaped = F.regexp_extract_all(lone, F.lit("(%[0-9A-Fa-f]{2}|[^%]+)"), 1)
    raw = F.transform(escaped, lambda x: F.when(x.startswith("%"), F.unhex(F.substr(x, F.lit(2), F.lit(2)))).otherwise(x.cast("binary")))
    return F.make_valid_utf8(F.aggregate(raw, F.lit(b""), lambda s, x: F.concat(s, x)).cast("string"))


def or_default(c: Column, empty, default) -> Column:
    """``default`` for null and for the empty value (0, '')."""
    return F.coalesce(F.nullif(c, F.lit(empty)), F.lit(default))
