"""Payloads of job platforms parsed to one posting shape.

A platform is a declaration: where its records lie and which paths its fields have. JSON is read as VARIANT, so a field
of an unexpected type is null instead of failing its record; XML feeds are read with from_xml. Every record comes out:
what can't be a posting carries the reason in `problem`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import text as T
from feedloom.functions.descriptions import basic_unescape

#: Plausible epochs: outside them a number is no date.
SECONDS, MILLIS = (1_000_000_000, 4_000_000_000), (1_000_000_000_000, 4_000_000_000_000)


def at(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def text_at(path: str) -> Callable[[Column], Column]:
    return lambda v: F.nullif(T.squeeze(at(v, path)), F.lit(""))


def true_at(path: str) -> Callable[[Column], Column]:
    """Whether the member at path is true, not a text or number that could be cast to it."""
    return lambda v: F.coalesce((F.schema_of_variant(at(v, path, "variant")) == "BOOLEAN") & at(v, path, "boolean"), F.lit(False))


def joined(paths: Sequence[str], separator: str) -> Callable[[Column], Column]:
    """Distinct non-empty texts at paths, in order; null for none."""
    return lambda v: F.nullif(F.array_join(F.array_distinct(F.filter(F.array(*[T.squeeze(at(v, p)) for p in paths]), lambda x: x != "")), separator), F.lit(""))


def joined_array(path: str, separator: str, inner: str | None = None, first: str | None = None) -> Callable[[Column], Column]:
    """Distinct non-empty texts of the array at path (of its objects' member inner), after the text at first; null for none."""

    def build(v: Column) -> Column:
        items = F.coalesce(at(v, path, "array<variant>"), F.array().cast("array<variant>"))
        texts = F.transform(items, lambda x: T.squeeze(at(x, inner or "$")))
        if first:
            texts = F.concat(F.array(T.squeeze(at(v, first))), texts)
        return F.nullif(F.array_join(F.array_distinct(F.filter(texts, lambda x: x != "")), separator), F.lit(""))

    return build


def texts_of(items: Column, inner: str = "$") -> Column:
    """The distinct non-empty texts of an array of VARIANT, of its objects' member inner, in order."""
    return F.array_distinct(F.filter(F.transform(items, lambda x: T.squeeze(at(x, inner))), lambda x: F.coalesce(x != "", F.lit(False))))


def items_at(v: Column, path: str) -> Column:
    return F.coalesce(at(v, path, "array<variant>"), F.array().cast("array<variant>"))


def some(texts: Column) -> Column:
    """texts, or null for none."""
    return F.when(F.size(texts) > 0, texts)


def labelled(v: Column, path: str, names: Sequence[str]) -> Column:
    """The texts of the values (one or a list) of the entries {name, value} at path whose name is one of names, in any case."""
    held = F.filter(items_at(v, path), lambda x: F.coalesce(F.lower(T.squeeze(at(x, "$.name"))).isin(*names), F.lit(False)))
    each = F.transform(held, lambda x: F.coalesce(at(x, "$.value", "array<variant>"), F.array(at(x, "$.value", "variant"))))
    return F.filter(F.transform(F.flatten(each), lambda x: T.squeeze(at(x, "$"))), lambda x: F.coalesce(x != "", F.lit(False)))


def parts_of(*paths: str, inside: str | None = None, members: Sequence[str] = ()) -> Callable[[Column], Column]:
    """The non-blank texts at paths, then of each member of the objects at inside, as they stand: a description in parts."""

    def build(v: Column) -> Column:
        out = F.array(*[at(v, p) for p in paths[:1]])
        if inside:
            out = F.concat(out, F.flatten(F.transform(items_at(v, inside), lambda x: F.array(*[at(x, f"$.{m}") for m in members]))))
        out = F.concat(out, F.array(*[at(v, p) for p in paths[1:]]).cast("array<string>"))
        return F.filter(out, lambda x: F.coalesce(F.trim(x) != "", F.lit(False)))

    return build


def hiring_employer(title: Column) -> Column:
    """The name before '(is) hiring' in a headline, without a batch mark '(YC S21)'; null where the headline says nothing of the kind."""
    name = F.regexp_extract(F.regexp_replace(title, r"(?i)\(\s*yc\s+[a-z]\d{2}\s*\)", " "), r"(?i)^(.*?\S)\s+(?:is\s+)?hiring\b", 1)
    return F.nullif(F.regexp_replace(T.squeeze(name), r"^[ ,-]+|[ ,-]+$", ""), F.lit(""))


def iso_date(c: Column) -> Column:
    """ISO date-time with an offset; without one it is no instant."""
    return F.when(F.rlike(c, F.lit(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})$")), F.try_to_timestamp(F.regexp_replace(c, r"([+-]\d{2})(\d{2})$", "$1:$2")))


def epoch_date(c: Column, window: tuple[int, int], per_second: int) -> Column:
    n = F.when(F.rlike(c, F.lit(r"^\d{1,18}(\.0*)?$")), F.regexp_replace(c, r"\..*$", "").cast("long"))
    return F.when(n.between(*window), F.timestamp_micros(n * (1_000_000 // per_second)))


def mail_date(c: Column) -> Column:
    """RFC 822 with a numeric offset or GMT."""
    bare = F.regexp_replace(F.regexp_replace(T.squeeze(c), r"^[A-Za-z]{3},\s*", ""), r"\b(GMT|UTC?|Z)$", "+0000")
    return F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z"))


def day_date(c: Column) -> Column:
    """A bare day of exactly ten characters, as its midnight UTC."""
    return F.when(F.rlike(c, F.lit(r"^\d{4}-\d{2}-\d{2}$")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))


DATES: dict[str, Callable[[Column], Column]] = {
    "iso": iso_date, "mail": mail_date, "day": day_date,
    "s": lambda c: epoch_date(c, SECONDS, 1), "ms": lambda c: epoch_date(c, MILLIS, 1000),
}


@dataclass(frozen=True)
class Platform:
    """records: path of the array of records ('$' for a payload that is one). Paths of fields; date_kind is a key of DATES, '' for none."""

    records: str
    id: str
    title: str
    url: str
    date: str = ""
    date_kind: str = ""
    employer: str | Callable[[Column], Column] | None = None
    location: Callable[[Column], Column] = field(default=lambda v: F.lit(None).cast("string"))
    workplace: Callable[[Column], Column] = field(default=lambda v: F.lit(None).cast("string"))
    skip: str | None = None  # records that have this member are no postings
    named: str | None = None  # path of the employer in the envelope, where records don't name it
    places: Callable[[Column], Column] = field(default=lambda v: F.lit(None).cast("array<string>"))
    levels: Callable[[Column], Column] = field(default=lambda v: F.lit(None).cast("array<string>"))
    expires: Callable[[Column], Column] = field(default=lambda v: F.lit(None).cast("string"))
    description: Callable[[Column], Column] = field(default=lambda v: F.lit(None).cast("array<string>"))
    distinct: bool = False  # pages shift while they are read: an id counts once a page


# Names of custom fields that hold a country, and how a role is worked.
COUNTRY, WORKED = ("country",), ("work type", "job type")


def _deadline(v: Column) -> Column:
    """A date as text, or as the member date of an object."""
    whole = F.schema_of_variant(at(v, "$.application_deadline", "variant"))
    return F.coalesce(text_at("$.application_deadline.date")(v), F.when(~F.startswith(whole, F.lit("OBJECT")), text_at("$.application_deadline")(v)))


def _one(path: str, drop: str | None = None) -> Callable[[Column], Column]:
    """The text at path as a list of one; null for none or for the word drop in any case."""
    return lambda v: F.when(F.lower(text_at(path)(v)) != F.lit(drop or ""), F.array(text_at(path)(v)))


def _comma_parts(path: str) -> Callable[[Column], Column]:
    return lambda v: F.nullif(F.array_join(F.array_distinct(F.filter(F.transform(F.split(at(v, path), ","), T.squeeze), lambda x: x != "")), ", "), F.lit(""))


def _countries(v: Column) -> Column:
    own = F.array(F.coalesce(text_at("$.address.postalAddress.addressCountry")(v), F.lit("")))
    return some(F.filter(F.array_distinct(F.concat(own, texts_of(items_at(v, "$.secondaryLocations"), "$.address.postalAddress.addressCountry"))), lambda x: x != ""))


# The platforms' member names.
PLATFORMS = {
    "greenhouse": Platform(
        "$.jobs", "$.id", "$.title", "$.absolute_url", "$.first_published", "iso", "$.company_name", text_at("$.location.name"), lambda v: F.get(labelled(v, "$.metadata", WORKED), F.lit(0)), expires=_deadline,
        places=lambda v: some(F.concat(texts_of(items_at(v, "$.offices"), "$.location"), labelled(v, "$.metadata", COUNTRY))), description=parts_of("$.content")),
    "lever": Platform(
        "$", "$.id", "$.text", "$.hostedUrl", "$.createdAt", "ms", None, text_at("$.categories.location"), text_at("$.workplaceType"),
        places=lambda v: F.when(text_at("$.country")(v).isNotNull(), F.array(F.upper(text_at("$.country")(v)))), description=parts_of("$.description", "$.additional", inside="$.lists", members=("text", "content"))),
    "himalayas": Platform(
        "$.jobs", "$.guid", "$.title", "$.applicationLink", "$.pubDate", "s", "$.companyName", joined_array("$.locationRestrictions", ", "), lambda v: F.lit("remote"),
        places=lambda v: some(texts_of(items_at(v, "$.locationRestrictions"))), levels=lambda v: some(texts_of(items_at(v, "$.seniority"))),
        expires=lambda v: F.date_format(epoch_date(at(v, "$.expiryDate"), SECONDS, 1), "yyyy-MM-dd'T'HH:mm:ss'Z'"), description=parts_of("$.description")),
    "manatal": Platform(
        "$.results", "$.id", "$.position_name", "", employer=None, location=lambda v: F.coalesce(text_at("$.location_display")(v), joined(("$.city", "$.state", "$.country"), ", ")(v)), description=parts_of("$.description"), distinct=True),
    "workable": Platform(
        "$.jobs", "$.shortcode", "$.title", "$.url", "$.published_on", "day", None, joined(("$.city", "$.state", "$.country"), ", "), lambda v: F.when(true_at("$.telecommuting")(v), "remote"),
        named="$.name", places=lambda v: some(texts_of(items_at(v, "$.locations"), "$.countryCode")), levels=_one("$.experience"), description=parts_of("$.description")),
    "smartrecruiters": Platform(
        "$.content", "$.id", "$.name", "", "$.releasedDate", "iso", "$.company.name", lambda v: F.coalesce(_comma_parts("$.location.fullLocation")(v), text_at("$.location.city")(v)),
        lambda v: F.when(true_at("$.location.remote")(v), "remote").when(true_at("$.location.hybrid")(v), "hybrid"), levels=_one("$.experienceLevel.label")),
    "ashby": Platform("$.jobs", "$.id", "$.title", "$.jobUrl", "$.publishedAt", "iso", None, joined_array("$.secondaryLocations", "; ", "$.location", "$.location"), text_at("$.workplaceType"), places=_countries, description=parts_of("$.descriptionHtml")),
    "hnjobs": Platform("$.hits", "$.objectID", "$.title", "$.url", "$.created_at", "iso", lambda v: hiring_employer(text_at("$.title")(v)), description=parts_of("$.story_text")),
    "jobicy": Platform("$.jobs", "$.id", "$.jobTitle", "$.url", "$.pubDate", "iso", "$.companyName", text_at("$.jobGeo"), lambda v: F.lit("remote"), levels=_one("$.jobLevel", "any"), description=parts_of("$.jobDescription")),
    "remoteok": Platform("$", "$.id", "$.position", "$.url", "$.date", "iso", "$.company", text_at("$.location"), lambda v: F.lit("remote"), skip="$.legal", description=parts_of("$.description")),
    "startupjobs": Platform("$.data", "$.id", "$.title", "$.url", "$.published_at", "iso", "$.company.name", joined(("$.location.city", "$.location.state", "$.location.country"), ", "), text_at("$.workplace_type"), description=parts_of("$.description_html")),
}


# The sections of a detail's advertisement, in the order they are shown.
SECTIONS = ("companyDescription", "jobDescription", "qualifications", "additionalInformation")


def records_of(pages: DataFrame, platform: Platform) -> DataFrame:
    """pages' columns with named (the envelope's employer), pos and record (VARIANT): the elements of each valid page's array, or the page itself where it is one record."""
    parsed = pages.withColumn("_v", F.try_parse_json("payload")).where("_v is not null")
    items = at(F.col("_v"), platform.records, "array<variant>")
    alone = F.schema_of_variant("_v").startswith("OBJECT")
    listed = F.coalesce(items, F.when(alone, F.array("_v")), F.array().cast("array<variant>"))
    named = text_at(platform.named)(F.col("_v")) if platform.named else F.lit(None).cast("string")
    return parsed.select(*pages.columns, named.alias("named"), F.posexplode(listed).alias("pos", "record"))


def parse(pages: DataFrame, platform_name: str, aliases: DataFrame | None = None) -> DataFrame:
    """page_id, source, board_id, pos, external_id, title, url, employer, published_raw, published_at, location, workplace, expires_at, places, levels, description, problem.

    problem is null for a posting; else the first of: not an object, no id, no title, url not absolute, unreadable date
    (a date that is absent is none). Payloads that are null or no valid JSON have no rows. aliases (board_id,
    employer_alias) names the employer where the payload doesn't.
    """
    p = PLATFORMS[platform_name]
    v = F.col("record")
    rows = records_of(pages.where(F.col("source") == platform_name).select("page_id", "source", "board_id", "payload"), p)
    if p.skip:
        rows = rows.where(F.coalesce(~F.schema_of_variant("record").startswith("OBJECT"), F.lit(True)) | at(v, p.skip).isNull())
    url = text_at(p.url)(v) if p.url else F.concat(F.lit("https://"), F.replace(F.lower("board_id"), F.lit(":"), F.lit(".example/")), F.lit("/"), at(v, p.id))
    raw = at(v, p.date) if p.date else F.lit(None).cast("string")
    when = DATES[p.date_kind](raw) if p.date else F.lit(None).cast("timestamp")
    rows = rows.select(
        "page_id", "source", "board_id", "pos", F.schema_of_variant("record").startswith("OBJECT").alias("_object"),
        text_at(p.id)(v).alias("external_id"), text_at(p.title)(v).alias("title"), url.alias("url"),
        F.coalesce(*([p.employer(v) if callable(p.employer) else text_at(p.employer)(v)] if p.employer else []), "named").alias("employer"),
        raw.alias("published_raw"), when.alias("published_at"), p.location(v).alias("location"), p.workplace(v).alias("workplace"),
        p.expires(v).alias("expires_at"), p.places(v).alias("places"), p.levels(v).alias("levels"), p.description(v).alias("description"),
    )
    problem = (
        F.when(~F.col("_object"), "not an object").when(F.col("external_id").isNull(), "no id").when(F.col("title").isNull(), "no title")
        .when(~F.coalesce(F.rlike(F.lower("url"), F.lit("^https?://")), F.lit(False)), "url not absolute")
        .when(F.col("published_raw").isNotNull() & F.col("published_at").isNull(), "unreadable date")
    )
    rows = rows.withColumn("problem", problem).drop("_object")
    if aliases is not None:
        names = aliases.groupBy("board_id").agg(F.max("employer_alias").alias("_alias"))
        rows = rows.join(names, "board_id", "left").withColumn("employer", F.coalesce("employer", "_alias")).drop("_alias")
    return distinct_in_page(rows) if p.distinct else rows


def parse_all(pages: DataFrame, names: Sequence[str], aliases: DataFrame | None = None) -> DataFrame:
    out = None
    for name in names:
        part = parse(pages, name, aliases)
        out = part if out is None else out.unionByName(part)
    return out


def wanted_details(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """(board_id, external_id) whose detail is still to be asked for: postings whose identity seen doesn't hold, each once."""
    new = rows.where("problem is null").select(F.concat_ws(":", "source", "external_id").alias("identity"), "board_id", "external_id").distinct()
    return new.join(seen.select("identity"), "identity", "left_anti").select("board_id", "external_id")


def with_details(rows: DataFrame, details: DataFrame) -> DataFrame:
    """rows with url and description taken from their detail (board_id, external_id, payload), where there is one.

    description is null where no detail was read and empty where one was that has no text. Of several details of a posting
    the greatest payload counts.
    """
    one = details.groupBy("board_id", "external_id").agg(F.max("payload").alias("_detail"))
    v = F.try_parse_json("_detail")
    sections = F.filter(F.array(*[at(v, f"$.jobAd.sections.{name}.text") for name in SECTIONS]), lambda x: F.coalesce(F.trim(x) != "", F.lit(False)))
    told = rows.join(one, ["board_id", "external_id"], "left")
    return told.withColumns({"url": F.coalesce(text_at("$.postingUrl")(v), F.col("url")), "description": F.when(v.isNotNull(), sections).otherwise(F.col("description"))}).select(*rows.columns)


def distinct_in_page(rows: DataFrame) -> DataFrame:
    """The first occurrence of each id in a page; records without an id all stay."""
    none = rows.where("external_id is null")
    rows = rows.where("external_id is not null")
    rest = [c for c in rows.columns if c not in ("page_id", "external_id")]
    one = rows.groupBy("page_id", "external_id").agg(F.min_by(F.struct(*rest), "pos").alias("_r"))
    return one.select("page_id", "external_id", *[F.col(f"_r.`{c}`").alias(c) for c in rest]).select(*rows.columns).unionByName(none)


def to_rows(postings: DataFrame, seen: DataFrame, now: Column) -> DataFrame:
    """Postings as canonical rows: identity, first_seen (kept once known), and the date that orders them with its provenance."""
    known = seen.groupBy("identity").agg(F.min("first_seen").alias("_seen"))
    rows = postings.where("problem is null").withColumn("identity", F.concat_ws(":", "source", "external_id")).join(known, "identity", "left")
    first = F.coalesce("_seen", now)
    return rows.select(
        "identity", "source", "board_id", "external_id", "employer", "title", "location", "published_at", first.alias("first_seen"),
        F.coalesce("published_at", first).alias("ordering_date"), F.when(F.col("published_at").isNotNull(), "publication").otherwise("first_seen").alias("ordering_date_source"), "url", "workplace",
    )


_ITEM = "array<struct<title:string,link:string,guid:string,pubDate:string,region:string,country:string,description:string>>"


def parse_rss(pages: DataFrame) -> DataFrame:
    """page_id, pos, external_id, employer, title, url, published_at, location of RSS items: 'Employer: Title' titles are cut at the first ': '."""
    feed = F.from_xml("payload", f"channel struct<item:{_ITEM}>", {"mode": "PERMISSIVE", "attributePrefix": "_"})
    items = pages.select("page_id", F.posexplode(feed["channel"]["item"]).alias("pos", "i"))
    title = T.squeeze("i.title")
    cut = F.instr(title, ": ")
    country = F.array_join(F.filter(F.transform(F.split(F.col("i.country"), ","), lambda c: T.squeeze(F.regexp_replace(c, r"[^\p{L}\p{M} .'-]", ""))), lambda c: c != ""), "; ")
    return items.select(
        "page_id", "pos", F.element_at(F.split(F.rtrim(F.coalesce("i.guid", "i.link"), F.lit("/")), "/"), -1).alias("external_id"),
        F.when(cut > 1, F.substring(title, F.lit(1), cut - 1)).alias("employer"), F.when(cut > 1, T.squeeze(F.substring(title, cut + 2, F.length(title)))).otherwise(title).alias("title"),
        F.col("i.link").alias("url"), mail_date(F.col("i.pubDate")).alias("published_at"), F.coalesce(F.nullif(country, F.lit("")), T.squeeze("i.region")).alias("location"),
    )


# Legal forms that belong to an employer's name though a comma stands before them.
LEGAL_FORMS = r"(?i)^(?:inc|llc|ltd|limited|gmbh|corp|corporation|co|plc|s\.?a|b\.?v|pvt\.? ltd|pte\.? ltd|ag|oy|ab|as|sas|srl)\.?$"


def role_and_employer(heading: Column) -> Column:
    """struct(title, employer) of 'Role, Employer': the last part between ', ' is the employer, with the one before it if the last is a legal form."""
    parts = F.split(heading, ", ")
    n = F.size(parts)
    taken = F.when((n > 2) & F.rlike(F.trim(F.element_at(parts, -1)), F.lit(LEGAL_FORMS)), 2).otherwise(1)
    cut = lambda start, length: F.trim(F.array_join(F.slice(parts, start, length), ", "))
    return F.when(n < 2, F.struct(heading.alias("title"), F.lit(None).cast("string").alias("employer"))).otherwise(F.struct(cut(F.lit(1), n - taken).alias("title"), cut(n - taken + 1, taken).alias("employer")))


def parse_listing(pages: DataFrame) -> DataFrame:
    """page_id, pos, external_id, title, employer, url, location, problem of RSS items 'Role, Employer' without dates.

    The id is the number that ends the link, the place the description's first line.
    """
    feed = F.from_xml("payload", f"channel struct<item:{_ITEM}>", {"mode": "PERMISSIVE", "attributePrefix": "_"})
    items = pages.select("page_id", F.posexplode(feed["channel"]["item"]).alias("pos", "i"))
    first = F.get(F.split(F.ltrim(F.col("i.description")), "\n", 2), F.lit(0))
    rows = items.select("page_id", "pos", F.nullif(F.regexp_extract("i.link", r"/(\d+)/?\s*$", 1), F.lit("")).alias("external_id"), role_and_employer(T.squeeze("i.title")).alias("r"), F.trim("i.link").alias("url"), F.nullif(T.squeeze(first), F.lit("")).alias("location"))
    title = F.nullif(F.col("r.title"), F.lit(""))
    problem = F.when(F.col("external_id").isNull(), "no id").when(~F.rlike(F.lower("url"), F.lit("^https?://")), "url not absolute").when(title.isNull(), "no title")
    return rows.select("page_id", "pos", "external_id", title.alias("title"), "r.employer", "url", "location", problem.alias("problem"))


def parse_atom(pages: DataFrame) -> DataFrame:
    """page_id, pos, external_id, title, employer, url, published_at, location, problem of Atom entries.

    The address is the link's href attribute and ends with the id; the employer is the linked name in bold that opens the content.
    """
    feed = F.from_xml("payload", "entry array<struct<title:string,link:struct<_href:string>,published:string,location:string,content:string>>", {"attributePrefix": "_"})
    items = pages.select("page_id", F.posexplode(feed["entry"]).alias("pos", "e"))
    url = F.trim("e.link._href")
    byline = F.nullif(T.squeeze(F.regexp_extract("e.content", r"<strong>\s*<a\b[^>]*>([^<]+)</a>", 1)), F.lit(""))
    rows = items.select(
        "page_id", "pos", F.nullif(F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1), F.lit("")).alias("external_id"), F.nullif(T.squeeze("e.title"), F.lit("")).alias("title"), byline.alias("employer"), url.alias("url"),
        iso_date(F.col("e.published")).alias("published_at"), T.squeeze("e.location").alias("location"),
    )
    problem = F.when(~F.coalesce(F.rlike(F.lower("url"), F.lit("^https?://")), F.lit(False)), "url not absolute").when(F.col("title").isNull(), "no title").when(F.col("published_at").isNull(), "unreadable date")
    return rows.withColumn("problem", problem)


#: The title of the thread to follow.
THREAD = r"(?i)^\s*ask hn:\s*who is hiring\?"


def newest_thread(listings: DataFrame, title: str = THREAD) -> DataFrame:
    """(page_id, thread): for each page of an account's stories, the id of the newest whose title matches; no row where none does."""
    rows = records_of(listings.select("page_id", "payload"), Platform("$.hits", "$.objectID", "", ""))
    v = F.col("record")
    dated = rows.select("page_id", at(v, "$.objectID").alias("thread"), at(v, "$.title").alias("_t"), F.coalesce(at(v, "$.created_at_i", "long"), F.lit(0)).alias("_at"))
    return dated.where(F.col("thread").isNotNull() & F.rlike("_t", F.lit(title))).groupBy("page_id").agg(F.max_by("thread", F.struct("_at", "thread")).alias("thread"))


def thread_header(text: Column) -> Column:
    """The first line of a thread comment, without tags: up to <p>, <br> or a line end."""
    first = F.get(F.split(text, r"(?i)<p>|<br\s*/?>|\n", 2), F.lit(0))
    return T.squeeze(basic_unescape(F.regexp_replace(first, "<[^>]*>", " ")))


def parse_thread(pages: DataFrame) -> DataFrame:
    """page_id, pos, external_id, employer, title, location, workplace of the children of a hiring thread; deleted ones (no text) are left out.

    The header's parts between bars: the first is the employer, without addresses; the others say role and place, in no
    fixed order, so they stand together as location, and the second as title. A header without bars names its employer
    before the first dash between blanks.
    """
    v = F.col("record")
    rows = records_of(pages.select("page_id", "payload"), Platform("$.children", "$.id", "", ""))
    rows = rows.select("page_id", "pos", at(v, "$.id").alias("external_id"), thread_header(at(v, "$.text")).alias("_h")).where("_h <> ''")
    parts = F.filter(F.transform(F.split("_h", r"\|"), T.squeeze), lambda x: x != "")
    rows = rows.withColumn("_p", parts)
    barred = F.size("_p") > 1
    name = F.when(barred, F.get("_p", F.lit(0))).otherwise(F.get(F.split("_h", r"\s[–—-]\s", 2), F.lit(0)))
    name = F.regexp_replace(T.squeeze(F.regexp_replace(name, r"\(\s*(?:https?://|www\.)[^)]*\)|https?://\S+|www\.\S+", " ")), r"^[ ,-]+|[ ,-]+$", "")
    remote = F.rlike("_h", F.lit(r"(?i)\bremote\b")) & ~F.rlike("_h", F.lit(r"(?i)\b(?:no|not) remote\b"))
    return rows.select(
        "page_id", "pos", "external_id", F.nullif(name, F.lit("")).alias("employer"), F.get("_p", F.lit(1)).alias("title"), F.when(barred, F.array_join(F.slice("_p", F.lit(2), F.size("_p")), " | ")).otherwise(F.col("_h")).alias("location"),
        F.when(remote, "remote").when(F.rlike("_h", F.lit(r"(?i)\bhybrid\b")), "hybrid").when(F.rlike("_h", F.lit(r"(?i)\bon-?site\b|\bin[- ](?:person|office)\b")), "on site").alias("workplace"),
    )
