"""Keys and small normalisers as column expressions, all inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Publishers by DOI prefix, and types of references.
PUBLISHERS = {
    "10.1002": "Wiley", "10.1111": "Wiley", "10.1080": "Taylor & Francis", "10.1177": "SAGE", "10.1007": "Springer", "10.1097": "Wolters Kluwer",
    "10.1093": "Oxford UP", "10.3233": "IOS Press", "10.1089": "Mary Ann Liebert", "10.1159": "Karger", "10.2196": "JMIR", "10.1186": "BMC",
}
RIS_TYPES = {
    "JOUR": "JOUR", "JOURNAL": "JOUR", "ARTICLE": "JOUR", "BOOK": "BOOK", "CHAP": "CHAP", "CHAPTER": "CHAP",
    "THES": "THES", "THESIS": "THES", "CONF": "CONF", "ELEC": "ELEC", "EJOUR": "JOUR", "GEN": "GEN", "RPRT": "RPRT", "REPORT": "RPRT",
}
DESIGN_WORDS = ("narrative review", "letter", "protocol", "commentary", "editorial", "cross-sectional", "case report", "case-control", "cohort study", "primary study")


def lookup(table: dict[str, str], key: Column, default: str) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key], F.lit(default))


def clean(c: Column, default: str) -> Column:
    """The text without surrounding blanks, or the default for null, NaN and blank."""
    plain = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.when(c.isNull() | (plain == "") | (F.lower(plain) == "nan"), default).otherwise(plain)


def doi_key(c: Column) -> Column:
    """DOI in lower case without scheme, host or 'doi' before it; blank and null give ''."""
    return F.coalesce(F.regexp_replace(F.lower(F.trim(c)), r"^(?:https?://[^/]+/|doi:?\s*)+", ""), F.lit(""))


def url_key(c: Column) -> Column:
    return F.coalesce(F.regexp_replace(F.lower(F.trim(c)), r"/+$", ""), F.lit(""))


def title_key_ascii(c: Column) -> Column:
    """Lower case; everything but ASCII letters and digits is a blank."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " ")), F.lit(""))


def title_key_words(c: Column) -> Column:
    """Lower case, blanks collapsed, then punctuation dropped; letters of all scripts stay."""
    return F.coalesce(F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"\s+", " "), r"(?U)[^\w\s]", "")), F.lit(""))


def title_key_untagged(c: Column) -> Column:
    """Tags are blanks; of the rest ASCII letters, digits and single blanks stay."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(c), r"<[^>]+>", " "), r"[^a-z0-9 ]", "")
    return F.coalesce(F.trim(F.regexp_replace(plain, r" +", " ")), F.lit(""))


def first_year(c: Column) -> Column:
    """The first four digits in a row, else ''."""
    return F.coalesce(F.regexp_extract(c, r"(\d{4})", 1), F.lit(""))


def leading_year(c: Column) -> Column:
    """The first four characters as a number, else null."""
    return F.substring(c, 1, 4).try_cast("int")


def first_author(c: Column) -> Column:
    """Last word of what stands before the first semicolon or comma."""
    head = F.trim(F.regexp_extract(c, r"^([^;,]*)", 1))
    return F.coalesce(F.regexp_extract(head, r"(\S+)$", 1), F.lit(""))


def safe_component(c: Column, longest: int = 80) -> Column:
    """A part of a file name: other characters become '_', none at the ends; 'untitled' if nothing is left."""
    plain = F.regexp_replace(F.coalesce(F.trim(c), F.lit("")), r"[^A-Za-z0-9._-]+", "_")
    cut = F.substring(F.regexp_replace(plain, r"^_+|_+$", ""), 1, longest)
    return F.when(cut == "", "untitled").otherwise(cut)


def target_filename(key: Column, doi: Column, title: Column) -> Column:
    tail = F.when(F.coalesce(doi, F.lit("")) != "", safe_component(doi)).otherwise(safe_component(title))
    return F.concat(key, F.lit("_"), tail, F.lit(".pdf"))


def publisher(doi: Column) -> Column:
    return lookup(PUBLISHERS, F.regexp_extract(doi, r"^(10\.\d+)", 1), "Other")


def is_stub(doi: Column) -> Column:
    """A trial register's entry instead of a publication."""
    up = F.upper(doi)
    return up.contains("ISRCTN") | up.contains("/CENTRAL/CN-") | up.startswith("10.1002/CENTRAL")


def is_true(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def url_host(c: Column) -> Column:
    return F.coalesce(F.replace(F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)), F.lit("www."), F.lit("")), F.lit(""))


# The patterns of addresses and DOIs below.
def citation_pdf_url(html: Column) -> Column:
    """Address in the meta tag citation_pdf_url, in either order of its attributes; null if there is none."""
    quote = "[\"']"
    a = F.regexp_extract(html, rf"(?i)<meta[^>]+name={quote}citation_pdf_url{quote}[^>]+content={quote}([^\"']+)", 1)
    b = F.regexp_extract(html, rf"(?i)<meta[^>]+content={quote}([^\"']+){quote}[^>]+name={quote}citation_pdf_url", 1)
    return F.when(a != "", a).when(b != "", b)


def pdf_links(html: Column) -> Column:
    """Addresses of PDF files in a page, each once, in order: the meta tag, quoted and bare attributes."""
    quoted = F.regexp_extract_all(html, F.lit("(?i)(?:href|content|src)\\s*=\\s*[\"']([^\"']+\\.pdf[^\"']*)"), 1)
    bare = F.regexp_extract_all(html, F.lit("(?i)(?:href|content|src)\\s*=\\s*([^\\s\"'>]+\\.pdf[^\\s\"'>]*)"), 1)
    found = F.concat(F.array_compact(F.array(citation_pdf_url(html))), quoted, bare)
    return F.array_distinct(F.transform(found, lambda u: F.replace(u, F.lit("&amp;"), F.lit("&"))))


def absolute_url(link: Column, page: Column) -> Column:
    """A link as seen from a page: with a scheme as it is, '//' under the page's scheme, '/' under its host, else under its folder."""
    base = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    folder = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/(?:[^?#]*/)?)", 1)
    within = F.when(folder != "", folder).otherwise(F.concat(base, F.lit("/")))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), link))
        .when(link.startswith("/"), F.concat(base, link))
        .otherwise(F.concat(within, link))
    )


def page_pdf_links(html: Column, page: Column) -> Column:
    """As ``pdf_links``, then files of a repository that have no ending; absolute, each once, in order."""
    stored = F.regexp_extract_all(html, F.lit("(?i)(https?://iris\\.who\\.int/server/api/core/bitstreams/[0-9a-fA-F-]+/content)"), 1)
    return F.array_distinct(F.transform(F.concat(pdf_links(html), stored), lambda u: absolute_url(u, page)))


def derived_pdf_urls(url: Column, doi: Column, html: Column) -> Column:
    """Addresses of the PDF file that follow from a landing page's own address: by publisher, the page's meta tag, and a DOI in its path."""
    base = F.regexp_extract(url, r"^([^/]+//[^/]+)", 1)
    plain = F.regexp_replace(url, r"/+$", "")
    direct = F.concat(base, F.lit("/doi/pdf/"), doi, F.lit("?download=true"))
    wiley = [F.concat(F.lit(f"https://onlinelibrary.wiley.com/doi/{kind}/"), doi, F.lit("?download=true")) for kind in ("pdfdirect", "pdf")]
    own = (
        F.when(url.contains("wiley.com"), F.array(*wiley))
        .when(url.contains("sagepub.com") | url.contains("tandfonline.com"), F.array(direct))
        .when(url.contains("springer.com"), F.array(F.concat(F.lit("https://link.springer.com/content/pdf/"), doi, F.lit(".pdf"))))
        .when(url.contains("jmir.org"), F.array(F.concat(plain, F.lit("/PDF"))))
        .when(url.contains("mdpi.com"), F.array(F.concat(plain, F.lit("/pdf"))))
        .otherwise(F.array().cast("array<string>"))
    )
    within = F.nullif(F.regexp_extract(url, r"/doi/(?:abs|full|epdf)?/?(10\.\d+/[^\s?#\"']+)", 1), F.lit(""))
    path = F.concat(base, F.lit("/doi/pdfdirect/"), within, F.lit("?download=true"))
    return F.array_distinct(F.array_compact(F.concat(own, F.array(absolute_url(citation_pdf_url(html), url), path))))


def dois_in(text: Column) -> Column:
    """DOIs in a text in lower case, each once, without punctuation after them."""
    found = F.regexp_extract_all(text, F.lit("(?i)(10\\.\\d{4,9}/[^\\s\"'<>)\\]}]+)"), 1)
    return F.array_distinct(F.transform(found, lambda d: F.regexp_replace(F.lower(d), r"[.,;:)\]}]+$", "")))


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]+>", " ")


def escape_html(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def is_pdf(content: Column) -> Column:
    """Binary content begins with the mark of a PDF file."""
    return F.coalesce(F.substring(content, 1, 4) == F.lit(b"%PDF"), F.lit(False))


def truncate_text(c: Column, limit: int) -> Column:
    """Cut to ``limit`` characters, at the last page break before it, else at the last empty line, if that keeps four
    fifths; else hard. Null stays null."""
    head = F.substring(c, 1, limit)

    def last(mark: str) -> Column:
        back = F.locate(mark[::-1], F.reverse(head))
        return F.when(back > 0, F.length(head) - back - len(mark) + 1)

    page, line = last("\n\f\n"), last("\n\n")
    at = F.when(page >= limit * 0.8, page).when(line >= limit * 0.8, line).otherwise(limit)
    return F.when(F.length(c) <= limit, c).otherwise(F.substring(c, F.lit(1), at.cast("int")))


def tokens(c: Column) -> Column:
    """Words of three or more letters or digits in lower case, with repeats."""
    return F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", " "), " "), lambda x: F.length(x) > 2)
