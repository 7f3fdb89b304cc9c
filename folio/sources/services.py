"""Recorded answers of bibliographic services as tables: (request, body), body null where a service knew nothing.

No service is called; ``readers.replay`` reads what was recorded. Every parser gives the columns of CANDIDATE, so that
sources can be united, merged and deduplicated by the operators of discovery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CANDIDATE = ("source", "id", "doi", "title", "abstract", "year", "date", "venue", "authors", "oa_url", "oa_status", "type", "cited_by", "relevance")
WORK = (
    "struct<id:string,doi:string,title:string,publication_year:int,publication_date:string,type:string,cited_by_count:int,relevance_score:double,"
    "authorships:array<struct<author:struct<display_name:string>>>,primary_location:struct<source:struct<display_name:string>>,"
    "open_access:struct<is_oa:boolean,oa_status:string,oa_url:string>,abstract_inverted_index:map<string,array<int>>>"
)
RECORD = (
    "struct<DOI:string,title:array<string>,`container-title`:array<string>,type:string,score:double,author:array<struct<given:string,family:string>>,"
    "issued:struct<`date-parts`:array<array<int>>>,`published-online`:struct<`date-parts`:array<array<int>>>,`published-print`:struct<`date-parts`:array<array<int>>>>"
)
LOCATIONS = "struct<best_oa_location:struct<url_for_pdf:string,url:string>,oa_locations:array<struct<url_for_pdf:string,url:string>>,error:string>"
MOST_AUTHORS, MOST_CREATORS = 6, 25


def bare_doi(doi: Column) -> Column:
    return F.regexp_replace(F.coalesce(doi, F.lit("")), "^https?://(dx[.])?doi[.]org/", "")


def abstract_of(index: Column) -> Column:
    """The words of an inverted index in order of their places; of two at one place the later entry wins."""
    places = F.flatten(F.transform(F.map_entries(index), lambda e, k: F.transform(e["value"], lambda p: F.struct(p.alias("p"), k.alias("k"), e["key"].alias("w")))))
    ordered = F.array_sort(places)
    last = F.filter(ordered, lambda x, k: (k == F.size(ordered) - 1) | (F.get(ordered, k + 1)["p"] != x["p"]))
    return F.coalesce(F.array_join(F.transform(last, lambda x: x["w"]), " "), F.lit(""))


def _work(w: Column) -> list[Column]:
    text = lambda c: F.coalesce(c, F.lit(""))
    names = F.transform(F.slice(F.coalesce(w["authorships"], F.from_json(F.lit("[]"), "array<struct<author:struct<display_name:string>>>")), 1, MOST_AUTHORS), lambda a: text(a["author"]["display_name"]))
    return [
        F.lit("openalex").alias("source"), text(w["id"]).alias("id"), bare_doi(w["doi"]).alias("doi"), text(w["title"]).alias("title"), abstract_of(w["abstract_inverted_index"]).alias("abstract"),
        w["publication_year"].alias("year"), text(w["publication_date"]).alias("date"), text(w["primary_location"]["source"]["display_name"]).alias("venue"), names.alias("authors"),
        text(w["open_access"]["oa_url"]).alias("oa_url"), F.coalesce(w["open_access"]["oa_status"], F.lit("closed")).alias("oa_status"), F.coalesce(w["type"], F.lit("article")).alias("type"),
        F.coalesce(w["cited_by_count"], F.lit(0)).alias("cited_by"), F.coalesce(w["relevance_score"], F.lit(0.0)).alias("relevance"),
    ]


def openalex_search(answers: DataFrame) -> DataFrame:
    """(request, place, CANDIDATE) of the works of a search."""
    works = F.from_json(F.get_json_object("body", "$.results"), f"array<{WORK}>")
    rows = answers.select("request", F.posexplode(works).alias("place", "w"))
    return rows.select("request", "place", *_work(F.col("w")))


def openalex_by_doi(dois: DataFrame, answers: DataFrame) -> DataFrame:
    """(doi asked, CANDIDATE), all null where nothing is known. dois: request."""
    known = answers.select("request", F.from_json("body", WORK).alias("w")).where("w is not null").select("request", *_work(F.col("w")))
    return dois.join(known, "request", "left")


def arxiv_entries(answers: DataFrame) -> DataFrame:
    """(request, place, CANDIDATE, creators) of Atom answers; creators: the first 25 as (last, rest)."""
    rows = answers.select("request", F.posexplode(F.regexp_extract_all("body", F.lit("(?s)<entry[ >].*?</entry>"), F.lit(0))).alias("place", "e"))
    at = lambda path: F.trim(F.regexp_replace(F.xpath_string("e", F.lit(path)), r"\s*\n\s*", " "))
    rows = rows.select("request", "place", at("entry/id").alias("page"), at("entry/title").alias("title"), at("entry/summary").alias("abstract"), at("entry/published").alias("at"), at("entry/link[@title='doi']/@href").alias("link"), F.xpath("e", F.lit("entry/author/name/text()")).alias("names"))
    page = F.col("page")
    short = F.regexp_extract(page, r"abs/([\w./-]+?)(v\d+)?$", 1)
    url = F.when(page.contains("abs"), F.concat(F.replace(page, F.lit("/abs/"), F.lit("/pdf/")), F.lit(".pdf"))).otherwise(page)
    year = F.when(F.substring("at", 1, 4).rlike("^[0-9]{4}$"), F.substring("at", 1, 4).cast("int"))
    words = lambda n: F.split(F.trim(n), r"\s+")
    creators = F.transform(F.slice(F.filter("names", lambda n: F.trim(n) != ""), 1, MOST_CREATORS), lambda n: F.struct(F.element_at(words(n), -1).alias("last"), F.array_join(F.slice(words(n), F.lit(1), F.size(words(n)) - 1), " ").alias("rest")))
    return rows.select(
        "request", "place", F.lit("arxiv").alias("source"), F.when(short != "", short).otherwise(page).alias("id"), bare_doi(F.col("link")).alias("doi"), "title", "abstract", year.alias("year"),
        F.substring("at", 1, 10).alias("date"), F.lit("arXiv").alias("venue"), F.slice("names", 1, MOST_AUTHORS).alias("authors"), url.alias("oa_url"), F.lit("green").alias("oa_status"),
        F.lit("preprint").alias("type"), F.lit(0).alias("cited_by"), F.lit(0.0).alias("relevance"), creators.alias("creators"),
    )


def crossref_work(dois: DataFrame, answers: DataFrame) -> DataFrame:
    """(request, record) for every DOI asked; null where it isn't known."""
    known = answers.select("request", F.from_json(F.get_json_object("body", "$.message"), RECORD).alias("record")).where("record is not null")
    return dois.join(known, "request", "left")


def crossref_search(answers: DataFrame, most: int = 5) -> DataFrame:
    """(id, pos, doi, title, family, year): the first candidates of a search, as ``discovery.best_candidates`` takes them."""
    items = F.slice(F.from_json(F.get_json_object("body", "$.message.items"), f"array<{RECORD}>"), 1, most)
    rows = answers.select(F.col("request").alias("id"), F.posexplode(items).alias("pos", "r"))
    parts = F.get(F.get(F.col("r.issued.date-parts"), F.lit(0)), F.lit(0))
    return rows.select("id", "pos", F.col("r.DOI").alias("doi"), F.coalesce(F.get("r.title", F.lit(0)), F.lit("")).alias("title"), F.get("r.author", F.lit(0))["family"].alias("family"), parts.alias("year"))


def open_locations(answers: DataFrame) -> DataFrame:
    """(request, place, url): the best location first, then the others, each url once; a PDF's url before its page's."""
    found = F.from_json("body", LOCATIONS)
    url = lambda x: F.coalesce(F.nullif(x["url_for_pdf"], F.lit("")), F.nullif(x["url"], F.lit("")))
    rows = answers.select("request", found.alias("r"))
    all_urls = F.concat(F.array(url(F.col("r.best_oa_location"))), F.coalesce(F.transform("r.oa_locations", url), F.expr("cast(array() as array<string>)")))
    return rows.select("request", F.posexplode(F.array_distinct(F.array_compact(all_urls))).alias("place", "url"))


def first_acceptable(probes: DataFrame, least: int = 20_000, refused: str = "не найдена", head: int = 3_000) -> DataFrame:
    """(request, try, body): the first try whose page is long enough and doesn't begin with a refusal. probes: request, try, body."""
    good = probes.where((F.length("body") >= least) & ~F.contains(F.substring("body", 1, head), F.lit(refused)))
    return good.groupBy("request").agg(F.min_by(F.struct("try", "body"), "try").alias("x")).select("request", "x.*")


def page_chain(pages: DataFrame, first: int = 1) -> DataFrame:
    """(act, n, text) along the links: from a page to the lowest linked page above it, until there is none, the page is empty,
    or its text was there before. pages: act, n, text, links (page numbers)."""
    acts = pages.groupBy("act").agg(F.array_sort(F.collect_list(F.struct("n", F.trim("text").alias("text"), "links"))).alias("pages"))
    kind = "struct<next:int,kept:array<struct<n:int,text:string>>>"

    def step(s: Column, p: Column) -> Column:
        above = F.array_min(F.filter(p["links"], lambda k: k > p["n"]))
        known = F.exists(s["kept"], lambda k: k["text"] == p["text"])
        on = F.struct(F.coalesce(above, F.lit(-1)).alias("next"), F.concat(s["kept"], F.array(F.struct(p["n"].alias("n"), p["text"].alias("text")))).alias("kept"))
        end = F.struct(F.lit(-1).alias("next"), s["kept"].alias("kept"))
        return F.when(s["next"] != p["n"], s).when((p["text"] == "") | known, end).otherwise(on).cast(kind)

    walked = F.aggregate("pages", F.struct(F.lit(first).alias("next"), F.expr("cast(array() as array<struct<n:int,text:string>>)").alias("kept")).cast(kind), step)
    return acts.select("act", F.explode(walked["kept"]).alias("x")).select("act", "x.*")
