"""Text of letters and multi-value cells."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


TAG = r"<[^>]*>"
BLANK = r"^\s+|\s+$"


def strip_blank(text: Column | str) -> Column:
    """Trim all white space, line ends included."""
    return F.regexp_replace(_col(text), BLANK, "")


def strip_tags(text: Column | str) -> Column:
    """Drop ``<...>`` fragments, trim; nothing left gives NULL."""
    return F.nullif(strip_blank(F.regexp_replace(_col(text).cast("string"), TAG, "")), F.lit(""))


# Markup of a page: comments (an open one runs to the end), declarations, and tags, whose quoted
# attributes may hold ``>``; a tag that the text ends in goes too. ``<`` before a blank is text.
REST = r"(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+>"
COMMENT = r"(?s)<!--.*?(?:-->|$)"
MARKUP = r"(?s)</?[A-Za-z](?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+(?:>|$)|</?[A-Za-z][^>]*(?:>|$)|<[!?/][^>]*(?:>|$)"


# What may be a reference at the start of the text behind ``&``.
REFERENCE = "^(?:#(?:[0-9]{1,9}|[xX][0-9a-fA-F]{1,7});?|[A-Za-z][A-Za-z0-9]*;?)"

#: A text with more different references than this decodes each by itself: maps are searched in line.
FEW_NAMES = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value worked out once; without it every use repeats the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _texts_by_name(names: dict[str, str]) -> Column:
    """A map from text to text as one literal."""
    return F.str_to_map(F.lit("\u0001".join(f"{k}\u0002{v}" for k, v in names.items())), F.lit("\u0001"), F.lit("\u0002"))


def decode_entities(text: Column | str) -> Column:
    """Named and numeric character references, each decoded once; unknown ones stay as they are.

    All names of HTML count, the old ones also without their semicolon and before further letters
    (the longest that fits). Numbers 128 to 159 are those of Windows, as browsers read them; numbers
    that are no characters become the replacement character. A no-break space becomes a blank.
    """
    blank = {"\u00a0": " "}
    closed = {n[:-1]: blank.get(c, c) for n, c in html5.items() if n.endswith(";")}
    old = {n: blank.get(c, c) for n, c in html5.items() if not n.endswith(";")}
    windows = {str(n): c for n in range(128, 160) if (c := bytes([n]).decode("cp1252", "ignore"))}
    of_closed, of_old, of_windows = _texts_by_name(closed), _texts_by_name(old), _texts_by_name(windows)

    def numbered(part: Column) -> Column:
        name = F.regexp_extract(part, "^#([0-9]{1,9}|[xX][0-9a-fA-F]{1,7});?", 1)
        number = F.when(name.rlike("^[xX]"), F.conv(F.substring(name, 2, 8), 16, 10)).otherwise(name).try_cast("bigint")

        def char(n: Column) -> Column:
            wide = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
            sound = (n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF)
            return F.when(n == 160, F.lit(" ")).when(n.between(128, 159), F.coalesce(F.try_element_at(of_windows, n.cast("string")), wide)).when(sound, wide).when(n.isNotNull(), F.lit("\ufffd"))

        rest = F.regexp_replace(part, "^#(?:[0-9]{1,9}|[xX][0-9a-fA-F]{1,7});?", "")
        return F.when(name != "", F.concat(F.get(F.transform(F.array(number), char), 0), rest))

    def named(part: Column) -> Column:
        name = F.regexp_extract(part, "^([A-Za-z][A-Za-z0-9]*);", 1)
        whole = F.concat(F.try_element_at(of_closed, name), F.substring(part, F.length(name) + 2, F.length(part)))
        lengths = sorted({len(n) for n in old}, reverse=True)
        prefixes = [F.concat(F.try_element_at(of_old, F.substring(part, 1, n)), F.substring(part, F.lit(n + 1), F.length(part))) for n in lengths]
        return F.when(part.rlike("^[A-Za-z]"), F.coalesce(F.when(name != "", whole), *prefixes))

    def decoded(part: Column) -> Column:
        return F.coalesce(F.when(part.startswith("#"), numbered(part)).otherwise(named(part)), F.concat(F.lit("&"), part))

    # Each different reference of a text is decoded once, as long as they are few; the rest one by one.
    def joined(parts: Column) -> Column:
        names = F.array_distinct(parts["name"])

        def by_name(of: Column) -> Column:
            texts = F.transform(parts, lambda p, i: F.when(i == 0, p["part"]).otherwise(F.concat(F.element_at(of, p["name"]), _behind(p))))
            return F.array_join(texts, "")

        few = _let(F.map_from_arrays(names, F.transform(names, decoded)), by_name)
        many = F.transform(parts, lambda p, i: F.when(i == 0, p["part"]).otherwise(decoded(p["part"])))
        return F.when(F.size(names) <= FEW_NAMES, few).otherwise(F.array_join(many, ""))

    def _behind(p: Column) -> Column:
        return F.substring(p["part"], F.length(p["name"]) + 1, F.length(p["part"]))

    named_parts = F.transform(F.split(_col(text), "&", -1), lambda p: F.struct(F.regexp_extract(p, REFERENCE, 0).alias("name"), p.alias("part")))
    return _let(named_parts, joined)


def _plain_sections(html: Column) -> Column:
    """What ``<![CDATA[...]]>`` holds as text whose signs are no markup; an open one runs to the end."""

    def opened(part: Column, i: Column) -> Column:
        held = F.split(part, "\\]\\]>", 2)
        inside = F.replace(F.replace(held[0], F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.when(i == 0, part).otherwise(F.concat(inside, F.coalesce(F.get(held, 1), F.lit(""))))

    return F.array_join(F.transform(F.split(html, r"<!\[CDATA\[", -1), opened), "")


def html_to_text(html: Column | str) -> Column:
    """Plain text with ``#`` headings, ``-`` items and paragraphs; scripts and styles removed."""
    c = _plain_sections(_col(html))
    for pattern, new in [
        (COMMENT, ""),
        (r"(?is)<(script|style)\b" + REST + r".*?(?:</\1\s*>|$)", ""),
        (r"(?i)<br\s*/?>", "\n"),
        (r"(?i)<h1\b" + REST, "\n\n# "),
        (r"(?i)<h2\b" + REST, "\n\n## "),
        (r"(?i)<h3\b" + REST, "\n\n### "),
        (r"(?i)<li\b" + REST, "\n- "),
        (r"(?i)</?(p|div|section|article|table|ul|ol|h[1-6]|tr)\b" + REST, "\n\n"),
        (MARKUP, ""),
    ]:
        c = F.regexp_replace(c, pattern, new)
    c = decode_entities(c)
    c = F.regexp_replace(c, r"[ \t]+", " ")
    c = F.regexp_replace(c, r" ?\n ?", "\n")
    c = F.regexp_replace(c, r"\n{3,}", "\n\n")
    return strip_blank(c)


def extract_section(xml: Column | str, section_id: str) -> Column:
    """Text of all ``content`` elements of a section, joined by a blank line.

    Tag names are matched in any case and stray tags are tolerated, as an HTML parser would. The
    section ends at its own closing tag, behind those of sections inside it, or with the document.
    NULL where the section is missing or empty.
    """
    start = r"(?is)<section\b[^>]*\bid=[\"']" + section_id + r"[\"'][^>]*>(.*)$"
    # Pieces that begin at the tags of sections; the depth says which closing tag is the own one.
    pieces = F.split(F.regexp_extract(_col(xml), start, 1), r"(?i)(?=</?section\b)", -1)
    first = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))

    def step(state: Column, piece: Column) -> Column:
        low = F.lower(F.substring(piece, 1, 9))
        change = F.when(low.startswith("</section"), -1).when(low.startswith("<section"), 1).otherwise(0)
        depth = F.when(state["depth"] > 0, state["depth"] + change).otherwise(0)
        return F.struct(depth.alias("depth"), (state["n"] + F.when(depth > 0, 1).otherwise(0)).alias("n"))

    body = _let(pieces, lambda p: F.array_join(F.slice(p, 1, F.aggregate(p, first, step)["n"]), ""))
    contents = F.regexp_extract_all(
        body, F.lit(r"(?is)<content\b" + REST + r"(.*?)</content\s*>"), F.lit(1)
    )
    texts = F.filter(
        F.transform(contents, lambda t: strip_blank(decode_entities(F.regexp_replace(t, MARKUP, "")))),
        lambda t: t != "",
    )
    return F.nullif(F.array_join(texts, "\n\n"), F.lit(""))


def lines_to_bars(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), r"\r?\n", "|")


def safe_name(text: Column | str) -> Column:
    """Letters, digits, ``_`` and ``-``; every other run becomes one dash; no dashes at the ends."""
    return F.regexp_replace(
        F.regexp_replace(_col(text), r"[^A-Za-z0-9_-]+", "-"), r"^-+|-+$", ""
    )


def normalise_finding_date(text: Column | str, document_date: Column | str | None = None) -> Column:
    """``12/19`` -> ``2019-12``, ``13.12.19`` -> ``2019-12-13``; else the document date."""
    c = F.trim(_col(text))

    def full_year(y: Column) -> Column:
        return F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)

    def two(x: Column) -> Column:
        return F.lpad(x, 2, "0")

    day = r"^(\d{1,2})\.(\d{1,2})\.(\d{4}|\d{2})$"
    month = r"^(\d{1,2})[/.](\d{4}|\d{2})$"
    result = (
        F.when(c.rlike(r"^[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?$"), c)
        .when(
            c.rlike(day),
            F.concat_ws(
                "-",
                full_year(F.regexp_extract(c, day, 3)),
                two(F.regexp_extract(c, day, 2)),
                two(F.regexp_extract(c, day, 1)),
            ),
        )
        .when(
            c.rlike(month),
            F.concat_ws(
                "-", full_year(F.regexp_extract(c, month, 2)), two(F.regexp_extract(c, month, 1))
            ),
        )
    )
    if document_date is None:
        return result
    fallback = F.regexp_extract(_col(document_date), r"^([0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?)", 1)
    return F.coalesce(result, F.nullif(fallback, F.lit("")))


# A date as letters write it, with nothing numeric around it.
_DAY, _MONTH, _YEAR = "(?:0?[1-9]|[12][0-9]|3[01])", "(?:0?[1-9]|1[0-2])", "(?:[12][0-9]{3}|[0-9]{2})"
DATE_IN_TEXT = (
    rf"(?:^|[^0-9./-])({_DAY}[.]{_MONTH}[.]{_YEAR}|{_MONTH}/{_YEAR}|{_MONTH}[.][12][0-9]{{3}}|[12][0-9]{{3}}-[01][0-9](?:-[0-3][0-9])?)"
    r"(?:$|[^0-9./-]|[.](?:$|[^0-9]))"
)


def date_in(sentence: Column | str) -> Column:
    """The first date a sentence names, as it is written; '' without one."""
    return F.regexp_extract(_col(sentence), DATE_IN_TEXT, 1)


def vaf_to_mutated(percent: Column | str) -> Column:
    """Allele frequency text (``12,5 %``) -> mutated above zero; NULL if not a number."""
    number = F.replace(F.regexp_replace(_col(percent).cast("string"), r"[%\s]", ""), F.lit(","), F.lit("."))
    return number.try_cast("double") > F.lit(0.0)


def labelled(parts: list[tuple[str, Column]], null_text: str = "nan") -> Column:
    """``label: value`` fragments in fixed order, missing values spelled out."""
    pieces = [
        F.concat(F.lit(label), F.coalesce(value.cast("string"), F.lit(null_text)))
        for label, value in parts
    ]
    return F.concat(*pieces)
