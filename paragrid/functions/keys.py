"""Keys of legal units: designators, file names, ECLI and CELEX."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Designator patterns and document types by CELEX letter.
PARAGRAPH = r"(?U)^§+\s*(\d+)([a-zA-Z]?)\b"
ARTICLE = r"(?U)^(?:Art\.?|Artikel)\s*(\d+)([a-zA-Z]?)\b"
ANNEX = r"(?U)^Anlage\s*(\d+)?([a-zA-Z]?)\b"
ARTICLE_HEAD = r"(?iU)^\s*Artikel\s+([0-9A-Za-z\-]+)\s*$"
CELEX_TYPES = {"R": "eu-verordnung", "L": "eu-richtlinie", "D": "eu-beschluss"}
OTHER_TYPE = "sonstige"
CELEX_PATTERN = "^3[0-9]{4}[RLD][0-9]{4}$"
CELEX_PATTERN_AS_PUBLISHED = "^[0-9]{4}3[RLD][0-9]{4}$"


def zero_pad(digits: Column, width: int) -> Column:
    """Left zeros up to a width; longer numbers stay whole, other texts give null."""
    stripped = F.regexp_replace(digits, "^0+(?=.)", "")
    return F.when(digits.rlike("^[0-9]+$"), F.when(F.length(stripped) >= width, stripped).otherwise(F.lpad(stripped, width, "0")))


def _numbered(text: Column, pattern: str, prefix: str = "") -> Column:
    number = F.regexp_extract(text, pattern, 1)
    padded = F.when(number == "", F.lit("0" * 4)).otherwise(zero_pad(number, 4))
    return F.concat(F.lit(prefix), padded, F.lower(F.regexp_extract(text, pattern, 2)))


def classify_designator(text: Column) -> Column:
    """struct(kind, padded) of a paragraph, article or annex; null for anything else."""
    clean = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\A\s+|\s+\z", "")
    kinds = (("paragraph", PARAGRAPH, ""), ("article", ARTICLE, "art-"), ("annex", ANNEX, ""))
    out = F.lit(None).cast("struct<kind:string,padded:string>")
    for kind, pattern, prefix in reversed(kinds):
        out = F.when(clean.rlike(pattern), F.struct(F.lit(kind).alias("kind"), _numbered(clean, pattern, prefix).alias("padded"))).otherwise(out)
    return out


def pad_ordinal(ordinal: Column) -> Column:
    """``1.10`` to ``01.10``; empty parts go, other texts stay."""
    parts = F.filter(F.split(ordinal, r"\."), lambda p: p != "")
    return F.array_join(F.transform(parts, lambda p: F.coalesce(zero_pad(p, 2), p)), ".")


def pad_article(number: Column) -> Column:
    """File key of an article number."""
    clean = F.trim(F.coalesce(number, F.lit("")))
    plain = F.concat(zero_pad(F.regexp_extract(clean, "^([0-9]+)([a-zA-Z]?)$", 1), 4), F.lower(F.regexp_extract(clean, "^([0-9]+)([a-zA-Z]?)$", 2)))
    other = F.regexp_replace(F.lower(clean), "[^A-Za-z0-9]+", "-")
    return (
        F.when(F.coalesce(number, F.lit("")) == "", "0000")
        .when(clean.rlike("^[0-9]+[a-zA-Z]?$"), plain)
        .otherwise(F.when(other == "", "0000").otherwise(other))
    )


def article_file(number: Column) -> Column:
    """File name of an article; preamble and annex have fixed places."""
    label = F.lower(F.trim(F.coalesce(number, F.lit(""))))
    return (
        F.when(label.isin("", "0", "praeambel"), "0000-praeambel.md")
        .when(label == "anhang", "9000-anhang.md")
        .otherwise(F.concat(pad_article(number), F.lit(".md")))
    )


def celex_type(celex: Column) -> Column:
    """Document type by the sixth character."""
    letter = F.substring(celex, 6, 1)
    out = F.lit(OTHER_TYPE)
    for k, v in CELEX_TYPES.items():
        out = F.when(letter == k, v).otherwise(out)
    return F.when(F.length(celex) < 6, OTHER_TYPE).otherwise(out)


def ecli_valid(ecli: Column) -> Column:
    """At least five parts, the first ECLI."""
    parts = F.split(F.coalesce(ecli, F.lit("")), ":")
    return (F.size(parts) >= 5) & (F.upper(F.get(parts, F.lit(0))) == "ECLI")


def ecli_path(ecli: Column) -> Column:
    """Repository path of a decision; null if the ECLI is not valid (see ``ecli_valid``)."""
    parts = F.split(ecli, ":")
    tail = F.translate(F.array_join(F.slice(parts, 5, F.greatest(F.size(parts) - 4, F.lit(0))), ":"), "/:", "_-")
    whole = F.concat_ws("/", F.lit("decisions"), F.upper(F.get(parts, F.lit(1))), F.upper(F.get(parts, F.lit(2))), F.get(parts, F.lit(3)), tail)
    return F.when(ecli_valid(ecli), whole)


def build_ecli(court: Column, iso_date: Column, case_no: Column) -> Column:
    """ECLI of a decision that has none; empty if a part is missing."""
    short = F.substr(F.replace(iso_date, F.lit("-"), F.lit("")), F.lit(3))
    made = F.concat(
        F.lit("ECLI:DE:"), F.upper(court), F.lit(":"), F.left(iso_date, F.lit(4)), F.lit(":"), short, F.regexp_replace(case_no, "[^A-Za-z0-9]", "")
    )
    missing = (F.coalesce(court, F.lit("")) == "") | (F.coalesce(iso_date, F.lit("")) == "") | (F.coalesce(case_no, F.lit("")) == "")
    return F.when(missing, "").otherwise(made)


def unit_label(path: Column) -> Column:
    """Label of a unit's file (``§ 7g``, ``Artikel 5``, ``Anlage 2``); other paths stay."""
    parts = F.split(path, "/")
    stem = F.substring_index(F.regexp_replace(F.element_at(parts, -1), r"\.md$", ""), "__", 1)
    core = F.regexp_replace(stem, "^art-", "")
    number = F.ltrim(F.left(core, F.lit(4)), F.lit("0"))
    number = F.when(number == "", "0").otherwise(number)
    rest = F.substr(core, F.lit(5))
    label = lambda word: F.rtrim(F.concat(F.lit(word + " "), number, rest))
    folder = F.get(parts, F.lit(2))
    annex = F.left(stem, F.lit(4))
    annex_number = F.ltrim(annex, F.lit("0"))
    annex_number = F.when(annex_number == "", "0").otherwise(annex_number)
    annex_rest = F.substr(stem, F.lit(5))
    return (
        F.when((F.size(parts) < 4) | ~path.endswith(".md"), path)
        .when((folder == "paragraphs") & stem.startswith("art-"), label("Artikel"))
        .when(folder == "paragraphs", label("§"))
        .when((folder == "annexes") & (annex_number == "0") & (annex_rest == ""), "Anlage")
        .when(folder == "annexes", F.rtrim(F.concat(F.lit("Anlage "), annex_number, annex_rest)))
        .otherwise(path)
    )


def slug_from_link(link: Column) -> Column:
    """Middle part of ``http(s)://host/<slug>/xml.zip``."""
    bare = F.regexp_replace(F.regexp_replace(link, "^https?://[^/]+", ""), r"/xml\.zip$", "")
    return F.trim(bare, F.lit("/"))


def page_of_archive(link: Column) -> Column:
    """Page that belongs to an archive link."""
    return F.regexp_replace(link, r"xml\.zip$", "")


def article_number(heading: Column) -> Column:
    """Number in an article heading, else its first digits with a letter, else empty."""
    whole = F.regexp_extract(heading, ARTICLE_HEAD, 1)
    return F.when(whole != "", whole).otherwise(F.regexp_extract(heading, r"[0-9]+[a-zA-Z]?", 0))


def register(spark) -> None:
    """SQL functions of the same names for ``spark.sql``; Unicode normal forms are their only Python step."""
    from .text import _nfc, _nfkd

    spark.udf.register("nfc_text", _nfc)
    spark.udf.register("nfkd_text", _nfkd)
    for name, sql in SQL_FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {name}{sql}")


_NUMBER = "concat(prefix, case when regexp_extract(t, pattern, 1) = '' then '0000' else zero_pad(regexp_extract(t, pattern, 1), 4) end, lower(regexp_extract(t, pattern, 2)))"
_STEM = r"substring_index(regexp_replace(element_at(split(path, '/'), -1), r'\.md$', ''), '__', 1)"
#: SQL forms of the keys and of canonical text; later ones use earlier ones.
SQL_FUNCTIONS = {
    "zero_pad": "(d string, w int) returns string return case when d rlike '^[0-9]+$' then lpad(regexp_replace(d, '^0+(?=.)', ''), greatest(w, length(regexp_replace(d, '^0+(?=.)', ''))), '0') end",
    "canonical_text": r"(t string) returns string return regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(nfc_text(coalesce(t, '')), r'[\x{200B}\x{200C}\x{200D}\x{FEFF}]', ''), ' ', ' '), r'[\p{Cc}&&[^\n\t]]', ''), r'(?U)\s+', ' '), '^ | $', '')",
    "slugify_ascii": r"(t string) returns string return regexp_replace(regexp_replace(lower(regexp_replace(nfkd_text(coalesce(t, '')), r'[^\x{0000}-\x{007F}]', '')), '[^a-z0-9._-]+', '-'), '^-+|-+$', '')",
    "trimmed": r"(t string) returns string return regexp_replace(coalesce(t, ''), r'(?U)\A\s+|\s+\z', '')",
    "unit_number": f"(t string, pattern string, prefix string) returns string return {_NUMBER}",
    "classify_designator": "(t string) returns struct<kind:string,padded:string> return case "
    + " ".join(
        f"when trimmed(t) rlike r'{p}' then named_struct('kind', '{k}', 'padded', unit_number(trimmed(t), r'{p}', '{x}'))"
        for k, p, x in (("paragraph", PARAGRAPH, ""), ("article", ARTICLE, "art-"), ("annex", ANNEX, ""))
    )
    + " end",
    "pad_ordinal": r"(t string) returns string return array_join(transform(filter(split(t, r'\.'), p -> p <> ''), p -> case when p rlike '^[0-9]+$' then lpad(regexp_replace(p, '^0+(?=.)', ''), greatest(2, length(regexp_replace(p, '^0+(?=.)', ''))), '0') else p end), '.')",
    "pad_article": "(t string) returns string return case when coalesce(t, '') = '' then '0000' when trim(t) rlike '^[0-9]+[a-zA-Z]?$' then concat(zero_pad(regexp_extract(trim(t), '^([0-9]+)([a-zA-Z]?)$', 1), 4), lower(regexp_extract(trim(t), '^([0-9]+)([a-zA-Z]?)$', 2))) when regexp_replace(lower(trim(t)), '[^A-Za-z0-9]+', '-') = '' then '0000' else regexp_replace(lower(trim(t)), '[^A-Za-z0-9]+', '-') end",
    "article_file": "(t string) returns string return case when lower(trim(coalesce(t, ''))) in ('', '0', 'praeambel') then '0000-praeambel.md' when lower(trim(t)) = 'anhang' then '9000-anhang.md' else concat(pad_article(t), '.md') end",
    "celex_type": "(celex string) returns string return case when length(celex) < 6 then 'sonstige' else coalesce(map('R', 'eu-verordnung', 'L', 'eu-richtlinie', 'D', 'eu-beschluss')[substring(celex, 6, 1)], 'sonstige') end",
    "ecli_path": "(ecli string) returns string return case when size(split(coalesce(ecli, ''), ':')) >= 5 and upper(substring_index(ecli, ':', 1)) = 'ECLI' then concat_ws('/', 'decisions', upper(get(split(ecli, ':'), 1)), upper(get(split(ecli, ':'), 2)), get(split(ecli, ':'), 3), translate(array_join(slice(split(ecli, ':'), 5, greatest(size(split(ecli, ':')) - 4, 0)), ':'), '/:', '_-')) end",
    "build_ecli": "(court string, day string, case_no string) returns string return case when coalesce(court, '') = '' or coalesce(day, '') = '' or coalesce(case_no, '') = '' then '' else concat('ECLI:DE:', upper(court), ':', left(day, 4), ':', substr(replace(day, '-', ''), 3), regexp_replace(case_no, '[^A-Za-z0-9]', '')) end",
    "label_number": "(stem string) returns string return concat(case when ltrim('0', left(stem, 4)) = '' then '0' else ltrim('0', left(stem, 4)) end, substr(stem, 5))",
    "unit_stem": f"(path string) returns string return {_STEM}",
    "unit_label": "(path string) returns string return case when size(split(path, '/')) < 4 or not endswith(path, '.md') then path "
    "when get(split(path, '/'), 2) = 'paragraphs' and startswith(unit_stem(path), 'art-') then rtrim(concat('Artikel ', label_number(substr(unit_stem(path), 5)))) "
    "when get(split(path, '/'), 2) = 'paragraphs' then rtrim(concat('§ ', label_number(unit_stem(path)))) "
    "when get(split(path, '/'), 2) = 'annexes' and label_number(unit_stem(path)) = '0' then 'Anlage' "
    "when get(split(path, '/'), 2) = 'annexes' then rtrim(concat('Anlage ', label_number(unit_stem(path)))) else path end",
    "slug_from_link": r"(link string) returns string return trim(both '/' from regexp_replace(regexp_replace(link, '^https?://[^/]+', ''), r'/xml\.zip$', ''))",
}
