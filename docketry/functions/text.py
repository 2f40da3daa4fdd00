"""Text cleaning as column expressions."""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"(?U)\s+"
BLANKS = " \t\n\r\f\x0b"
PUNCTUATION = r"\p{Punct}"
# One stray mark of each kind, outermost first, as seen from either end of a value.
LEADING_MARKS = r"^\.?,?[()]?:?\*?;?\??"
TRAILING_MARKS = r"\??;?\*?:?[()]?,?\.?$"
MOBILE = r"^((\+44(\s\(0\)\s|\s0\s|\s)?)|0)7\d{3}(\s)?\d{6}$"
UK_POSTCODE = r"^(GIR0AA|[A-Z]{1,2}[0-9][A-Z0-9]?[0-9][A-Z]{2})$"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once, also when ``body`` loops over it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_marks(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, LEADING_MARKS, ""), TRAILING_MARKS, "")


def clean_email(text: Column) -> Column:
    return strip_marks(F.regexp_replace(text, SPACES, ""))


def clean_phone(text: Column) -> Column:
    """Compact form with +44 for the 0044 and 44 prefixes."""
    number = F.regexp_replace(clean_email(text), r"[.\-]", "")
    number = F.regexp_replace(number, r"^0044", "+44")
    number = F.regexp_replace(number, r"\(0\)", "")
    number = F.regexp_replace(number, r"^44", "+44")
    return F.regexp_replace(number, r"\)", "")


def mobile_only(text: Column) -> Column:
    """The cleaned number when it is a mobile number, else NULL."""
    number = clean_phone(text)
    return F.when(number.rlike(MOBILE), number)


def pad_left(text: Column, width: int, fill: str = "0") -> Column:
    """Pad to ``width``; longer text stays whole."""
    return F.when(F.length(text) < width, F.lpad(text, width, fill)).otherwise(text)


def _reference_digits(body: Column) -> Column:
    """The digits of a reference without its prefix, by the form it is written in."""
    bare = F.regexp_replace(body, "[a-zA-Z]", "")
    # Text after the last slash loses its leading zeros and joins what stands before it.
    joined = F.when(
        bare.contains("/"),
        F.concat(F.regexp_replace(bare, "(?s)/[^/]*$", ""), F.regexp_replace(F.substring_index(bare, "/", -1), "^0+", "")),
    ).otherwise(bare)
    digits = F.regexp_replace(body, r"\D", "")
    after_slash = F.regexp_replace(body, r"(?s)^[^/]*/", "")
    tail = F.regexp_extract(body, r"^.*/(\d+)$", 1)
    located = body.contains("/") & (body.startswith("SHEF") | body.startswith("UKPLA") | body.startswith("UKVS"))
    return (
        F.when((F.length(body) > 9) & (F.length(body) < 16), pad_left(joined, 9))
        .when(F.length(body) < 9, pad_left(digits, 9))
        .when(located, pad_left(after_slash, 9))
        .when(tail != "", pad_left(tail, 9))
        .when(digits != "", pad_left(digits, 9))
        .otherwise(body)
    )


def normalise_reference(raw: Column) -> Column:
    """A nine-digit reference from its many written forms; a GWF prefix is kept.

    Masked (X...), empty and 'NULL' values become NULL. The trimmed text and the part after the prefix
    are bound once: the branches would otherwise compute them again and again.
    """

    def whole(ref: Column) -> Column:
        upper = F.upper(ref)
        missing = raw.isNull() | (raw == "") | (upper == "NULL") | upper.rlike(r"^X{2,32}$")
        marked = upper.startswith("GWF")
        body = F.when(marked, F.substr(ref, F.lit(4))).otherwise(ref)
        return F.when(~missing, F.concat(F.when(marked, F.lit("GWF")).otherwise(F.lit("")), bind(body, _reference_digits)))

    return bind(F.btrim(raw, F.lit(BLANKS)), whole)


def full_address(*lines: Column, null_text: str | None = None) -> Column:
    """Address lines joined by ', '; missing lines are left out, or shown as ``null_text``."""
    if null_text is None:
        return F.concat_ws(", ", *lines)
    return F.concat_ws(", ", *[F.coalesce(c.cast("string"), F.lit(null_text)) for c in lines])


def postcode_valid(raw: Column) -> Column:
    """A UK postcode, if need be after swapping O/0 and I/1 in the inward part."""

    def check(code: Column) -> Column:
        size = F.length(code)
        repaired = F.concat(
            F.substr(code, F.lit(1), size - 3),
            F.translate(F.substr(code, size - 2, F.lit(1)), "OI", "01"),
            F.translate(F.substr(code, size - 1, F.lit(2)), "01", "OI"),
        )
        return code.rlike(UK_POSTCODE) | ((size >= 5) & repaired.rlike(UK_POSTCODE))

    return F.coalesce(bind(F.regexp_replace(F.upper(raw), SPACES, ""), check), F.lit(False))


def strip_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, PUNCTUATION, "")


def words(text: Column) -> Column:
    """Space-separated words without line breaks or tabs at their ends."""
    return F.split(F.btrim(text, F.lit(BLANKS)), r"[\t\n\r\f\x0b]* [\t\n\r\f\x0b]*")


def name_in_text(text: Column, names: Sequence[str]) -> Column:
    """The last word that is a name; else the last one once punctuation is dropped; else the first one
    after splitting on commas and dots too. '' without a match, NULL for NULL text.

    One search over the text without punctuation decides whether any name is there at all; only then is it cut
    into words. ``array_intersect`` keeps the order of its first array, so its first entry is the first match;
    all steps run on whole arrays without a function per word.
    """
    marks = dict.fromkeys(map(ord, string.punctuation))
    anywhere = "|".join(re.escape(n.lower().translate(marks)) for n in names) or "(?!)"
    known = F.array(*[F.lit(n.lower()) for n in names])

    def first(items: Column) -> Column:
        return F.try_element_at(F.array_intersect(items, known), F.lit(1))

    def pick(low: Column) -> Column:
        pieces = F.regexp_replace(low, r"[\p{Punct}&&[^,.]]", "")
        return F.coalesce(
            first(F.reverse(words(low))),
            first(F.reverse(words(strip_punctuation(low)))),
            first(F.split(pieces, r"[,.\s]+")),
            F.lit(""),
        )

    low = F.lower(text)
    return F.when(strip_punctuation(low).rlike(anywhere), F.initcap(pick(low))).when(text.isNotNull(), F.lit(""))


def first_contained(text: Column, names: Sequence[str]) -> Column:
    """The first name of the list that the text contains, ignoring case and punctuation; else ''."""
    clean = strip_punctuation(F.lower(text))
    wanted = F.array(*[F.lit(n.lower()) for n in names])
    found = bind(clean, lambda t: F.try_element_at(F.filter(wanted, lambda n: F.contains(t, n)), F.lit(1)))
    return F.initcap(F.coalesce(found, F.lit("")))


def in_country(country_id: Column, home_id: int, postcode: Column, lines: Sequence[Column], country: Column) -> Column:
    """Whether an address lies in the home country, by id, postcode, address line or resolved name."""
    home = F.coalesce(country_id == home_id, F.lit(False)) | postcode_valid(postcode)
    for c in lines:
        home = home | F.coalesce(_home(c), F.lit(False))
    return home | F.coalesce(country.isin("GB", "UK", "United Kingdom"), F.lit(False))


def _home(line: Column) -> Column:
    return F.lower(line).isin("gb", "uk", "united kingdom")


def resolve_country(
    country_id: Column, country: Column, postcode: Column, lines: Sequence[Column], names: Sequence[str]
) -> Column:
    """The looked-up country; for id 0 the home code or a name found in the address; else a marker."""
    home = postcode_valid(postcode)
    for c in lines:
        home = home | F.coalesce(_home(c), F.lit(False))
    searched = F.when(home, F.lit("GB")).otherwise(name_in_text(F.concat_ws(", ", *lines), names))
    return F.when(country.isNotNull(), country).when(country_id == 0, searched).otherwise(F.lit("NO MAPPING REQUIRED"))


def area_lookup(postcode: Column, areas: Mapping[str, str], default: Column | None = None) -> Column:
    """The value for the two-letter postcode area, else for the one-letter area, else ``default``."""
    from docketry.operators.projection import map_lookup

    code = F.upper(postcode)
    found = F.coalesce(map_lookup(F.substr(code, F.lit(1), F.lit(2)), areas), map_lookup(F.substr(code, F.lit(1), F.lit(1)), areas))
    return found if default is None else F.coalesce(found, default)


def squeeze(text: Column) -> Column:
    """Line breaks and runs of blanks become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def pad_code(code: Column, width: int) -> Column:
    return pad_left(code, width)


def join_non_empty(sep: str, *cols: Column) -> Column:
    """Joined text, or NULL when nothing is left."""
    return F.nullif(F.concat_ws(sep, *cols), F.lit(""))


def labelled_block(title: str, fields: Sequence[tuple[str, Column]], missing: str = "N/A") -> Column:
    """'label: value' lines under a title with a default for missing values."""
    pieces: list[Column] = [F.lit(title)]
    for label, value in fields:
        pieces += [F.lit(f"\n{label}: "), F.coalesce(value.cast("string"), F.lit(missing))]
    return F.concat(*pieces)


def person_name(surname: Column, forenames: Column, title: Column) -> Column:
    """'Surname Forenames (Title)'; NULL without a surname."""
    return F.when(
        surname.isNotNull(),
        F.concat_ws(" ", surname, forenames, F.when(title != "", F.concat(F.lit("("), title, F.lit(")")))),
    )


def normalise_key(name: Column, prefix: str = "", suffixes: Sequence[str] = ()) -> Column:
    """The record key inside a file name: folder, prefix and suffix removed, '_' back to '/'."""
    base = F.substring_index(name, "/", -1)
    if prefix:
        base = F.regexp_replace(base, f"^{prefix}", "")
    if suffixes:
        base = F.regexp_replace(base, "(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$", "")
    return F.replace(base, F.lit("_"), F.lit("/"))


def html_escape(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for raw, safe in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out
