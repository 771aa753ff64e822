"""Sources and their activation: full sources, registered ones without an adapter, and the adapter contract."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The sixteen states, their ISO letters, names and portals.
STATES = (
    ("bw", "Baden-Württemberg", "https://www.landesrecht-bw.de"),
    ("by", "Bayern", "https://www.gesetze-bayern.de"),
    ("be", "Berlin", "https://gesetze.berlin.de"),
    ("bb", "Brandenburg", "https://bravors.brandenburg.de"),
    ("hb", "Bremen", "https://www.transparenz.bremen.de"),
    ("hh", "Hamburg", "https://www.landesrecht-hamburg.de"),
    ("he", "Hessen", "https://www.rv.hessenrecht.hessen.de"),
    ("mv", "Mecklenburg-Vorpommern", "https://www.landesrecht-mv.de"),
    ("ni", "Niedersachsen", "https://www.voris.niedersachsen.de"),
    ("nw", "Nordrhein-Westfalen", "https://recht.nrw.de"),
    ("rp", "Rheinland-Pfalz", "https://landesrecht.rlp.de"),
    ("sl", "Saarland", "https://www.saarland.de/recht"),
    ("sn", "Sachsen", "https://www.revosax.sachsen.de"),
    ("st", "Sachsen-Anhalt", "https://www.landesrecht.sachsen-anhalt.de"),
    ("sh", "Schleswig-Holstein", "https://www.gesetze-rechtsprechung.sh.juris.de"),
    ("th", "Thüringen", "https://landesrecht.thueringen.de"),
)
SOURCES = (("bund", "full"), ("vwv", "full"), ("rechtsprechung", "full"), ("eu", "full"), ("land", "registry"), ("neuris", "decoder"))


class SourceAdapter(Protocol):
    """What a source gives: its listing, its raw documents, its parsed records, and their rendered files."""

    def listing(self, spark: SparkSession, path: str) -> DataFrame: ...

    def documents(self, spark: SparkSession, path: str) -> DataFrame: ...

    def records(self, documents: DataFrame) -> DataFrame: ...

    def rendered(self, records: DataFrame) -> DataFrame: ...


_ADAPTERS: dict[str, Callable[[], SourceAdapter]] = {}


def register(name: str, factory: Callable[[], SourceAdapter]) -> None:
    """Make an adapter known under a source's name, for example ``land/by``."""
    _ADAPTERS[name] = factory


def adapter(name: str) -> SourceAdapter:
    """The adapter of a source; a source without one is refused."""
    if name not in _ADAPTERS:
        raise NotImplementedError(f"no adapter for {name}")
    return _ADAPTERS[name]()


def states(spark: SparkSession) -> DataFrame:
    """The states as a dimension of sixteen rows, with whether an adapter is there."""
    rows = [(iso, name, portal, "adapter" if f"land/{iso}" in _ADAPTERS else "registered") for iso, name, portal in STATES]
    return spark.createDataFrame(rows, "iso string, name string, upstream string, status string")


class FederalLaws:
    """Adapter of the federal laws: listing XML, archives, parsed laws."""

    def listing(self, spark: SparkSession, path: str) -> DataFrame:
        from .readers import law_listing

        return law_listing(spark, path)

    def documents(self, spark: SparkSession, path: str) -> DataFrame:
        from .readers import archives

        return archives(spark, path, ordered=True).withColumnRenamed("stem", "bjnr")

    def records(self, documents: DataFrame) -> DataFrame:
        from .laws import parse_laws

        return parse_laws(documents)

    def rendered(self, records: DataFrame) -> DataFrame:
        from ..operators.snapshot import rendered_sections
        from .laws import section_table

        made = rendered_sections(section_table(records.where("error is null")))
        return made.select(F.regexp_replace("path", "/[^/]*$", "").alias("doc"), "path", "md")


class Decisions:
    """Adapter of the court decisions."""

    def listing(self, spark: SparkSession, path: str) -> DataFrame:
        from .readers import decision_listing

        return decision_listing(spark, path)

    def documents(self, spark: SparkSession, path: str) -> DataFrame:
        from .readers import archives

        return archives(spark, path, ordered=False).withColumnRenamed("stem", "key")

    def records(self, documents: DataFrame) -> DataFrame:
        from .decisions import parse_decisions

        return parse_decisions(documents)

    def rendered(self, records: DataFrame) -> DataFrame:
        from ..functions.keys import build_ecli, ecli_path
        from ..operators.render import decision_markdown

        fields = ("ecli", "court", "date", "case_no", "decision_type", "leitsaetze", "tenor", "gruende", "normrefs")
        path = F.coalesce(ecli_path(F.col("ecli")), ecli_path(build_ecli(F.col("court"), F.col("date"), F.col("case_no"))))
        sound = records.where("error is null").select(path.alias("doc"), decision_markdown(**{c: F.col(c) for c in fields}).alias("md"))
        return sound.where("doc is not null").select("doc", F.concat("doc", F.lit("/decision.md")).alias("path"), "md")


def _pages(spark: SparkSession, path: str) -> DataFrame:
    """HTML files of a folder: stem and bytes."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").load(path)
    return found.select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.html$", "").alias("stem"), "path", F.col("content").alias("html"))


class Regulations:
    """Adapter of the administrative regulations: landing pages, detail pages, sections."""

    def __init__(self, base_url: str = "https://www.verwaltungsvorschriften-im-internet.de"):
        self.base_url = base_url

    def listing(self, spark: SparkSession, path: str) -> DataFrame:
        from .portals import regulation_listing

        return regulation_listing(_pages(spark, path).select(F.col("stem").alias("doc"), "html"), self.base_url)

    def documents(self, spark: SparkSession, path: str) -> DataFrame:
        return _pages(spark, path).select(F.col("stem").alias("doc"), F.col("path").alias("url"), "html")

    def records(self, documents: DataFrame) -> DataFrame:
        from .portals import regulation_pages

        return regulation_pages(documents)

    def rendered(self, records: DataFrame) -> DataFrame:
        from ..functions.keys import pad_ordinal
        from ..functions.text import slugify_ascii
        from ..operators.folds import first_filled
        from ..operators.render import ordinal_markdown

        slug = first_filled(slugify_ascii(F.col("short")), slugify_ascii(F.col("title")), F.lit("unnamed"))
        rows = records.where("error is null").select(F.concat(F.lit("vwv/"), slug).alias("doc"), "short", F.explode("sections").alias("s"))
        md = ordinal_markdown(schema_version="v2", short=F.col("short"), ordinal=F.col("s.ordinal"), heading=F.col("s.heading"), text=F.col("s.text"))
        return rows.select("doc", F.concat("doc", F.lit("/"), pad_ordinal(F.col("s.ordinal")), F.lit(".md")).alias("path"), md.alias("md"))


class EuActs:
    """Adapter of the EU acts: JSON listings, pages named ``<celex>.<language>.html``, articles."""

    def listing(self, spark: SparkSession, path: str) -> DataFrame:
        from .readers import read_listing

        return read_listing(spark, path)

    def __init__(self, languages: tuple[str, ...] | None = None):
        if languages is not None and not all(languages or ("",)):
            raise ValueError("a language must not be empty")
        self.languages = languages

    def documents(self, spark: SparkSession, path: str) -> DataFrame:
        """Pages of all languages, or with ``languages`` of each act the first of these that is there."""
        pages = _pages(spark, path)
        language = F.when(F.col("stem").contains("."), F.substring_index("stem", ".", -1)).otherwise("de")
        rows = pages.select(F.substring_index("stem", ".", 1).alias("celex"), language.alias("language"), "html")
        if self.languages is None:
            return rows
        place = F.array_position(F.array(*map(F.lit, self.languages)), F.col("language"))
        best = rows.select("celex", place.alias("place")).where("place > 0").groupBy("celex").agg(F.min("place").alias("best"))  # without the pages
        return rows.withColumn("best", place).join(best, ["celex", "best"], "left_semi").drop("best")

    def records(self, documents: DataFrame) -> DataFrame:
        from .portals import eu_pages

        return eu_pages(documents)

    def rendered(self, records: DataFrame) -> DataFrame:
        from ..functions.keys import article_file
        from ..operators.render import article_markdown

        doc = F.concat_ws("/", F.lit("eu"), "doc_type", "celex", "language")
        rows = records.where("error is null").select(doc.alias("doc"), "celex", "doc_type", "language", "title", F.explode("articles").alias("a"))
        fields = {c: F.col(c) for c in ("celex", "doc_type", "language", "title")}
        md = article_markdown(schema_version="v2", number=F.col("a.number"), heading=F.col("a.heading"), paragraphs=F.col("a.paragraphs"), **fields)
        return rows.select("doc", F.concat("doc", F.lit("/"), article_file(F.col("a.number"))).alias("path"), md.alias("md"))


class Promulgations:
    """Adapter of the promulgation events: one JSON document a line; a decoder only, nothing is rendered."""

    def listing(self, spark: SparkSession, path: str) -> DataFrame:
        return self.records(self.documents(spark, path)).select("eli", "effective_date")

    def documents(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.text(path)

    def records(self, documents: DataFrame) -> DataFrame:
        from .readers import promulgation

        return documents.select(promulgation(F.col("value")).alias("p")).select("p.*")

    def rendered(self, records: DataFrame) -> DataFrame:
        raise NotImplementedError("promulgations are not rendered")


register("bund", FederalLaws)
register("rechtsprechung", Decisions)
register("vwv", Regulations)
register("eu", EuActs)
register("neuris", Promulgations)
