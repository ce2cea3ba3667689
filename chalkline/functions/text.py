"""Column functions on text: tokens, words, lines, slugs, links. All run in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chalkline.resources.wordlists import CODE_KEYWORDS, LANGUAGE_CODES, stopwords

#: Runs that make a search token: names of code such as std::move or push_back stay whole, a dot parts them.
#: A run starts and ends with another character than a colon.
TOKEN = "[a-z0-9_+#](?:[a-z0-9_:+#]*[a-z0-9_+#])?"
#: Letters, digits and underscores, of any script.
WORD = r"[\p{L}\p{N}_]+"
#: What Python's str.split and str.strip take for white space.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: The same characters, one after another.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: What Python's str.splitlines takes for the end of a line.
LINE_END = r"\r\n|[\n\x0B\x0C\r\x1C-\x1E\x{85}\x{2028}\x{2029}]"
#: The ends but a newline; the pair comes before its second half.
OTHER_ENDS = ["\r\n", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029"]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))  # looks at the ends alone, where a pattern would be tried at every character


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES))


def literal_array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def tokens(text: Column) -> Column:
    """Search tokens of the lower-cased text, without colons at their ends."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 0)


def content_of(found: Column, language: str = "en") -> Column:
    """Those of the tokens that are neither single characters nor stop words."""
    return F.filter(found, lambda x: (F.length(x) > 1) & ~x.isin(stopwords(language)))


def content_tokens(text: Column, language: str = "en") -> Column:
    """Search tokens but single characters and stop words."""
    return content_of(tokens(text), language)


def stop_array(language: Column) -> Column:
    """Stop words of a language column; none for an unknown language."""
    from chalkline.resources.wordlists import languages

    out = literal_array([])
    for code in languages():
        out = F.when(F.lower(language) == code, literal_array(stopwords(code))).otherwise(out)
    return out


def content_words(text: Column, language: Column) -> Column:
    """Distinct words of two letters at least, without stop words."""
    found = F.filter(F.regexp_extract_all(F.lower(text), F.lit(WORD), 0), lambda x: F.length(x) >= 2)
    return F.array_except(F.array_distinct(found), stop_array(language))


def overlap(a: Column, b: Column) -> Column:
    """Words that two arrays of words share."""
    return F.size(F.array_intersect(a, b))


def raw_lines(text: Column) -> Column:
    """Lines without their ends; none for an empty text, none after a last line end."""
    parts = F.split(text, LINE_END)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)


def lines(text: Column) -> Column:
    return F.transform(raw_lines(text), rstrip)


def first_lines(listed: Column) -> Column:
    """Lines in order; of those that agree without white space at their ends, the first."""
    empty = F.struct(F.array().cast("array<string>").alias("keys"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        key = rstrip(x)
        seen = F.array_contains(acc.keys, key)
        return F.when(seen, acc).otherwise(F.struct(F.array_append(acc.keys, key).alias("keys"), F.array_append(acc.out, x).alias("out")))

    return F.aggregate(listed, empty, step, lambda acc: acc.out)


def slug(name: Column) -> Column:
    made = F.regexp_replace(F.regexp_replace(strip(F.lower(name)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(made == "", "concept").otherwise(made)


def concept_key(name: Column) -> Column:
    return strip(F.lower(name))


def canonical_id(name: Column, prefix: Column | str) -> Column:
    """The id of a concept's name. It depends on the name alone, so it needs no registry to look up."""
    return F.concat(F.lit(prefix) if isinstance(prefix, str) else prefix, F.lit(":"), slug(name))


def dependency_ids(names: Column, prefix: Column | str) -> Column:
    return F.transform(names, lambda n: canonical_id(n, prefix))


def language_code(value: Column) -> Column:
    key = strip(F.lower(value))
    table = F.create_map(*[F.lit(x) for pair in LANGUAGE_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), key)


def has_term(text: Column, term: Column) -> Column:
    """Whether a term is in a text as whole words, case aside."""
    quoted = F.concat(F.lit(r"\Q"), F.replace(F.lower(term), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    return F.regexp_like(F.lower(text), F.concat(F.lit(r"(?<![\p{L}\p{N}_])"), quoted, F.lit(r"(?![\p{L}\p{N}_])")))


def looks_like_code(text: Column) -> Column:
    """A brace anywhere; or a semicolon and a keyword, an equals sign or a bracket."""
    keyword = F.regexp_like(text, F.lit(r"\b(" + "|".join(CODE_KEYWORDS) + r")\b"))
    return F.regexp_like(text, F.lit("[{}]")) | (text.contains(";") & (keyword | text.contains("=") | text.contains("(")))


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value made once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def one_kind_of_ends(text: Column) -> Column:
    """With a newline for each end of a line."""
    for end in OTHER_ENDS:
        text = F.replace(text, F.lit(end), F.lit("\n"))
    return text


def strip_fence(raw: Column) -> Column:
    """A reply without the code fence around it. Each step reads the text a fixed number of times."""

    def inside(body: Column) -> Column:
        last = F.substring_index(body, "\n", -1)
        kept = F.substring(body, F.lit(1), F.length(body) - F.length(last) - 1)
        return strip(F.when(strip(last) == "```", kept).otherwise(body))

    def opened(text: Column) -> Column:
        first = F.locate("\n", text)
        return F.when(first > 0, _once(F.substring(text, first + 1, F.length(text)), inside)).otherwise("")

    return _once(strip(raw), lambda text: F.when(text.startswith("```"), _once(one_kind_of_ends(text), opened)).otherwise(text))


def hms(seconds: Column) -> Column:
    """hh:mm:ss of whole seconds, hours not wrapped; negative times are 0."""
    total = F.when(seconds > 0, F.floor(seconds)).otherwise(0).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(total / 3600), F.floor(total % 3600 / 60), total % 60)


def timestamp_link(source: Column, seconds: Column) -> Column:
    """A link into the source if it is a page of the one video site that takes times; else the bracketed time."""
    video = F.regexp_like(source, F.lit("^https?://")) & (source.contains("youtube.com") | source.contains("youtu.be"))
    mark = F.when(source.contains("?"), "&").otherwise("?")
    whole = F.when(seconds >= 0, F.floor(seconds)).otherwise(F.ceil(seconds)).cast("long").cast("string")
    plain = F.concat(F.lit("["), hms(seconds), F.lit("]"))
    return F.when(video, F.concat(plain, F.lit("("), source, mark, F.lit("t="), whole, F.lit(")"))).otherwise(plain)


def frame_rate(rate: Column) -> Column:
    """num/den as a number; 0 for what isn't one or has no denominator."""
    parts = F.split(rate, "/")
    number = lambda i: F.try_cast(F.get(parts, i), "double") if hasattr(F, "try_cast") else F.get(parts, i).try_cast("double")
    value = F.when(F.size(parts) == 1, number(0)).when(F.size(parts) == 2, F.try_divide(number(0), number(1)))
    return F.coalesce(value, F.lit(0.0))


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, f"{SPACE}+"), lambda x: x != ""))


def searchable_text(concept: Column, summary: Column, code: Column) -> Column:
    full = lambda c: F.nullif(c, F.lit(""))
    return strip(F.concat_ws(" ", full(concept), full(summary), full(code)))


def data_url(content: Column, mime: Column) -> Column:
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.base64(content))


def request_key(*fields: Column) -> Column:
    """Hash of a request's named fields in order of their names; the key of the reply table."""
    return F.sha2(F.to_json(F.struct(*fields)), 256)
