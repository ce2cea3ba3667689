r"""Line dedup by winnowing over line hashes, in DataFrame operations.

A text is its sequence of lines that aren't blank. Besides a newline, a line ends after the end of a
sentence and before a capital letter, so that a passage is the same lines wherever it was put into a
text, wrapped or joined with what stands around it.

What goes: a run of lines that holds ``min_words`` words goes wherever the same run stands at an earlier
place, in order of (doc_id, text hash, line), that it does not overlap; and so the whole of each maximal
run that a text shares with an earlier place.

How it is found. A window starts at a line and takes the fewest lines that hold ``min_words`` words. Each
window selects the least hash of two lines in it that follow one another (of its line, if it is one), and these minima
are the text's fingerprints: a run that two places share holds a whole window, and so a fingerprint of both. Fingerprints are joined, and those of one place
dropped. The places of the others are extended to both sides: to the left by the windows that start
before the fingerprint and hold it, to the right by those lines behind a run's last whole window that hold
fewer than ``min_words`` words together, a line at a time. Each window, with or without such lines, is
matched with its first place only, never with all pairs of places, which is enough: a line of a shared
run is in a window that starts in the run, or else behind the last of them, in the lines it is extended by.

Lines are compared without white space at their ends. Blank lines inside a deleted run go with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, absent, remove, same, session, written

#: Words that a repeated run holds at least.
MIN_WORDS = 50
#: What a line ends with: the pieces put together are the text. And the same as the places between two
#: characters, many times slower, for texts that hold the mark that is otherwise put there.
LINE_END = r"[.!?][\x20\t]|[\x20\t](?=\p{Lu})|\n"
BETWEEN = r"(?<=\n)|(?<=[.!?][\x20\t])|(?<=[\x20\t])(?=\p{Lu})"
MARK = "\x01"


def pieces(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.when(text.contains(MARK), F.split(text, BETWEEN)).otherwise(F.split(F.regexp_replace(text, LINE_END, f"$0{MARK}"), MARK))


def _trimmed(text: Column) -> Column:
    """The pieces without white space at their ends; a text with none but single spaces and newlines has a faster way."""
    text = F.coalesce(text, F.lit(""))
    cut = F.replace(text, F.lit("\n"), F.lit(MARK))
    for mark in ".!?":
        cut = F.replace(cut, F.lit(f"{mark} "), F.lit(f"{mark}{MARK}"))
    parts = F.split(F.regexp_replace(cut, r" (?=\p{Lu})", MARK), MARK)
    any_ = F.transform(pieces(text), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")))
    return F.when(_odd(text) | text.contains(MARK), any_).otherwise(F.transform(parts, lambda x: F.trim(x)))


def _odd(text: Column) -> Column:
    """Whether words of the text may be parted by other than single spaces and line ends."""
    odd = text.contains("  ")
    for c in "\t\x0b\x0c\r":
        odd = odd | text.contains(c)
    return odd


def _words(line: Column, odd: Column) -> Column:
    """Words of a trimmed line; its spaces are counted where single ones part them."""
    spaces = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    return F.when(odd, F.size(F.split(line, f"[{SPACES}]+"))).otherwise(spaces + 1)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; as an expression it would be made anew for each element of a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _objects(array: Column) -> Column:
    """An array of a row as objects: of one that is still bytes, each slice would copy the whole."""
    return F.transform(array, lambda x: x)


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _sizes(words: Column, min_words: int) -> Column:
    """Lines of the window at each line, by its words; 0 where too few words are left."""

    def of(line_of: Column) -> Column:  # the line of each word
        new = lambda at: F.coalesce(F.get(line_of, at - 1), F.lit(-1)) != F.get(line_of, at)
        starts = F.filter(F.sequence(F.lit(0), F.size(line_of) - 1), new)
        counted = F.transform(starts, lambda at, i: F.coalesce(F.get(line_of, at + (min_words - 1)) - i + 1, F.lit(0)))
        return F.when(F.size(line_of) == 0, F.array().cast("array<int>")).otherwise(counted)

    return _let(F.flatten(F.transform(words, lambda w, i: F.array_repeat(i, w))), of)


def _minima(hs: Column, sizes: Column, min_words: int) -> Column:
    """The fingerprint of the window at each line, null without one; from the minima of 1, 2, 4, ... pairs of lines."""
    most = F.array_max(sizes)

    def level(minima: dict[int, Column], size: int) -> Column:
        if 2 * size >= min_words:

            def pick(n: Column, i: Column) -> Column:
                of = lambda k: F.least(F.get(minima[k], i), F.get(minima[k], i + n - (k + 1)))
                return F.when(n > 1, F.coalesce(*[F.when(n <= 2 * k, of(k)) for k in sorted(minima)])).when(n == 1, F.get(hs, i))

            return F.transform(sizes, pick)
        double = F.when(most > 2 * size, F.transform(minima[size], lambda x, i: F.least(x, F.get(minima[size], i + size))))
        return _let(double, lambda made: level({**minima, 2 * size: made}, 2 * size))

    return _let(F.transform(hs, lambda h, i: F.xxhash64(h, F.get(hs, i + 1))), lambda pairs: level({1: pairs}, 1))


def lines(docs: DataFrame, min_words: int = MIN_WORDS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each text: doc_id, th (text hash), and arrays over its lines: h (hash), piece
    (place among ``pieces``; null if no piece is blank, as places are then the same), n (lines of the window from there; 0 without one) and mark (its fingerprint)."""
    text = docs[text_col]
    base = docs.select(docs[id_col].alias("doc_id"), _text_hash(text).alias("th"), _trimmed(text).alias("all"), _odd(F.coalesce(text, F.lit(""))).alias("odd"))
    blank = F.array_contains("all", "")
    full = base.select("doc_id", "th", "odd", F.when(blank, F.filter("all", lambda x: x != "")).otherwise(F.col("all")).alias("full"),
                       F.when(blank, F.filter(F.sequence(F.lit(0), F.size("all") - 1), lambda i: F.get("all", i) != "")).alias("piece"))
    made = full.select("doc_id", "th", "piece", F.transform("full", lambda x: F.xxhash64(x)).alias("h"), F.transform("full", lambda x: _words(x, F.col("odd"))).alias("w"))
    sized = made.select("doc_id", "th", "piece", "h", _sizes(F.col("w"), min_words).alias("n"))
    return sized.select("doc_id", "th", "piece", "h", "n", _minima(F.col("h"), F.col("n"), min_words).alias("mark"))


def _windows(all_: DataFrame, marks: DataFrame, shared: DataFrame) -> DataFrame:
    """A row for each window that holds a shared fingerprint: at, n, run (hash of its lines), first and last (pieces),
    and more, more_pieces: hashes and pieces of the lines it may be extended by."""
    kept = marks.join(shared.hint("shuffle_hash"), "mark", "left_semi").groupBy(F.col("doc_id").alias("k_doc"), F.col("th").alias("k_th")).agg(F.collect_set(F.struct("a", "b")).alias("kept"))
    near = all_.join(kept.hint("shuffle_hash"), same(F.col("doc_id"), F.col("k_doc")) & (F.col("th") == F.col("k_th")))

    def window(hs: Column, i: Column) -> Column:
        n, following = F.get("n", i), F.get("n", i + 1)
        more = F.when(following > 0, following - n).otherwise(F.size("n") - i - n)
        return F.struct(i.alias("at"), n.alias("n"), F.xxhash64(F.slice(hs, i + 1, n)).alias("run"), F.coalesce(F.get("piece", i), i).alias("first"), F.coalesce(F.get("piece", i + n - 1), i + n - 1).alias("last"),
                        F.when(more > 0, F.slice(hs, i + n + 1, more)).alias("more"), F.when(more > 0, F.slice("piece", i + n + 1, more)).alias("more_pieces"))

    chosen = F.flatten(F.transform("kept", lambda s: F.sequence(s["a"], s["b"])))
    return near.select("doc_id", "th", F.inline(_let(_objects(F.col("h")), lambda hs: F.transform(chosen, lambda i: window(hs, i)))))


def _first_places(places: DataFrame, key: str) -> DataFrame:
    """(key, a_doc, a_th, a_end): where the lines of each key that has several places stand first, and where they end there."""
    place = F.struct("doc_id", "th", "at", "n")
    runs = places.groupBy(key).agg(F.min(place).alias("a"), F.count(F.lit(1)).alias("places")).where("places > 1")
    return runs.select(key, F.col("a.doc_id").alias("a_doc"), F.col("a.th").alias("a_th"), (F.col("a.at") + F.col("a.n")).alias("a_end"))


def _is_later() -> Column:
    return ~same(F.col("doc_id"), F.col("a_doc")) | (F.col("th") != F.col("a_th")) | (F.col("at") >= F.col("a_end"))


def repeated(docs: DataFrame, min_words: int = MIN_WORDS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, gone, n_lines): the pieces to delete, of each text that has some, and how many lines they are."""
    spark = session(docs)
    held: list[DataFrame] = []

    def hold(df: DataFrame, label: str) -> DataFrame:
        held.append(written(df, label))
        return held[-1]

    try:
        all_ = hold(lines(docs, min_words, id_col=id_col, text_col=text_col), "lines")  # before any filter, which would pull the lines' expression into its lambda
        # a fingerprint stays one over a stretch of lines; over one longer than the window at its start, it is of two places
        last = lambda i, after: F.coalesce(after, F.size("mark")) - 1
        starts = F.filter(F.sequence(F.lit(0), F.size("mark") - 1), lambda i: F.get("mark", i).isNotNull() & ~F.get("mark", i).eqNullSafe(F.get("mark", i - 1)))
        ends = F.filter(F.sequence(F.lit(0), F.size("mark") - 1), lambda i: F.get("mark", i).isNotNull() & ~F.get("mark", i).eqNullSafe(F.get("mark", i + 1)))
        stretch = lambda a, b: F.struct(F.get("mark", a).alias("mark"), a.alias("a"), b.alias("b"), (b - a >= F.get("n", a)).alias("twice"))
        some = all_.where(F.size("mark") > 0).select("doc_id", "th", F.inline(_let(ends, lambda to: F.transform(starts, lambda a, k: stretch(a, F.get(to, k))))))
        marks = hold(some, "marks")
        # a repeated row counts as a place here, which only lets more through
        shared = hold(marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("twice")).where("n > 1 or twice").select("mark"), "shared")
        spans = hold(_windows(all_, marks, shared), "windows")
        runs = hold(_first_places(spans, "run"), "runs")
        later = spans.join(runs.hint("shuffle_hash"), "run").where(_is_later())
        found = later.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.struct("at", "n", "first", "last", "run", F.col("more").isNotNull().alias("more")))).alias("spans"))
        before = lambda i: F.get("spans", i - 1)
        # ends rise with starts, so a window adds what lies behind the one before it; nothing, if it ends where that does
        new_lines = F.transform("spans", lambda s, i: F.struct(F.greatest(s["at"], F.coalesce(before(i)["at"] + before(i)["n"], F.lit(0))).alias("a"), (s["at"] + s["n"] - 1).alias("b")))
        new_pieces = F.transform("spans", lambda s, i: F.struct(F.greatest(s["first"], F.coalesce(before(i)["last"] + 1, F.lit(0))).alias("a"), s["last"].alias("b")))
        # the last window of each unbroken series of repeated ones may be extended
        open_ = F.filter("spans", lambda s, i: s["more"] & ~(s["at"] + 1).eqNullSafe(F.get("spans", i + 1)["at"]))
        found = hold(found.select("doc_id", "th", new_lines.alias("lines"), new_pieces.alias("pieces"), F.transform(open_, lambda s: s["run"]).alias("open")), "found")

        # extend: with one more line after another, each against its first place
        ends_ = hold(found.select(F.explode("open").alias("run")).distinct(), "ends")
        longer = F.transform(F.sequence(F.lit(1), F.size("more")), lambda k: F.struct(k.alias("k"), F.xxhash64(F.col("run"), F.slice("more", F.lit(1), k)).alias("key"), F.coalesce(F.get("more_pieces", k - 1), F.col("at") + F.col("n") + k - 1).alias("to")))
        more = spans.where("more is not null").join(ends_, "run", "left_semi").select("doc_id", "th", "at", F.col("n").alias("whole"), "last", F.inline(longer))
        more = hold(more.withColumn("n", F.col("whole") + F.col("k")), "longer")
        behind = more.join(_first_places(more, "key"), "key").where(_is_later())
        extra = behind.groupBy(F.col("doc_id").alias("e_doc"), F.col("th").alias("e_th")).agg(
            F.collect_set(F.struct((F.col("at") + F.col("whole")).alias("a"), (F.col("at") + F.col("n") - 1).alias("b"))).alias("x_lines"), F.collect_set(F.struct((F.col("last") + 1).alias("a"), F.col("to").alias("b"))).alias("x_pieces"))
        both = found.join(extra, same(F.col("doc_id"), F.col("e_doc")) & (F.col("th") == F.col("e_th")), "left")

        def whole(spans_: str, extra_: str) -> Column:
            of = F.concat(F.filter(spans_, lambda s: s["a"] <= s["b"]), F.coalesce(extra_, F.array().cast("array<struct<a:int,b:int>>")))
            return F.array_distinct(F.flatten(F.transform(of, lambda s: F.sequence(s["a"], s["b"]))))

        return written(both.select("doc_id", "th", whole("pieces", "x_pieces").alias("gone"), F.size(whole("lines", "x_lines")).alias("n_lines")), "gone")
    finally:
        remove(spark, *held)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated runs of lines deleted from the text, and ``lines_removed`` (in place of a column of that name).

    A null text stays null and an empty one empty; a document all of whose lines are repeated
    becomes empty; a very long text is cut like any other, its lines held by one task at a time. Rows that agree
    in id and text are one place and so are cut alike; rows that share an id only are ordered by the
    hash of their text. A null id comes first. An empty table gives an empty one. Other columns stay,
    whatever their names.
    """
    gone = repeated(docs, min_words, id_col=id_col, text_col=text_col)
    doc, th, cut_, count, made = absent(docs, "doc", "th", "gone", "n_lines", "pieces")
    gone = gone.select(F.col("doc_id").alias(doc), F.col("th").alias(th), F.col("gone").alias(cut_), F.col("n_lines").alias(count))
    text = docs[text_col]
    # one strategy at every size: texts are dealt by id and hash, and need no order
    joined = docs.join(gone.hint("shuffle_hash"), same(docs[id_col], F.col(doc)) & (_text_hash(text) == F.col(th)), "left")
    # pieces are a column of their own: as an expression they would be made anew for each piece
    joined = joined.withColumn(made, F.when(F.col(cut_).isNotNull(), pieces(text)))
    stay = F.array_except(F.sequence(F.lit(0), F.size(made) - 1), F.col(cut_))
    cut = F.array_join(F.transform(stay, lambda i: F.get(made, i)), "")
    kept = [F.when(F.col(cut_).isNull(), text).otherwise(cut).alias(c) if c == text_col else docs[c] for c in docs.columns if c.lower() != "lines_removed"]
    return joined.select(*kept, F.coalesce(count, F.lit(0)).alias("lines_removed"))


#: DuckDB SQL for ``dedup_lines`` on the table documents: doc_id, text and lines_removed. Lines stand for their hashes.
#: A maximal repeated run is the fewest lines that hold 50 words from each of its lines on, and those up to each of its lines.
#: Ids are taken to be distinct, as they are in the given tables, and chr(1) to be in no text.
SQL = r"""
WITH l0 AS (SELECT doc_id, string_split(regexp_replace(replace(regexp_replace(coalesce(text, ''), '([\x20\t])(\p{Lu})', '\1' || chr(1) || '\2', 'g'), chr(10), chr(10) || chr(1)), '([.!?][\x20\t])', '\1' || chr(1), 'g'), chr(1)) AS ls FROM documents),
l1 AS (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS p FROM l0),
l2 AS (SELECT doc_id, p, ls[p] AS raw, regexp_replace(ls[p], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS s FROM l1),
l AS (SELECT doc_id, p, s, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS k, len(regexp_split_to_array(s, '[\x20\x09-\x0D]+')) AS w FROM l2 WHERE s <> ''),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY k) - w AS before, sum(w) OVER (PARTITION BY doc_id) AS total FROM l),
starts AS (SELECT a.doc_id, a.k AS k1, count(*) AS n, min(b.p) AS first, max(b.p) AS last, string_agg(b.s, chr(10) ORDER BY b.k) AS run
           FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.k >= a.k AND b.before < a.before + 50 WHERE a.total - a.before >= 50 GROUP BY a.doc_id, a.k),
ends AS (SELECT a.doc_id, min(b.k) AS k1, count(*) AS n, min(b.p) AS first, max(b.p) AS last, string_agg(b.s, chr(10) ORDER BY b.k) AS run
         FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.k <= a.k AND b.before + b.w > a.before + a.w - 50 WHERE a.before + a.w >= 50 GROUP BY a.doc_id, a.k),
win AS (SELECT * FROM starts UNION SELECT * FROM ends),
one AS (SELECT run, doc_id AS a_doc, k1 + n AS a_end FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, k1) AS r FROM win) WHERE r = 1),
later AS (SELECT DISTINCT doc_id, unnest(generate_series(first, last)) AS p FROM win JOIN one USING (run) WHERE doc_id <> a_doc OR k1 >= a_end),
kept AS (SELECT l2.doc_id, string_agg(l2.raw, '' ORDER BY l2.p) AS text FROM l2 ANTI JOIN later ON l2.doc_id = later.doc_id AND l2.p = later.p GROUP BY l2.doc_id),
n AS (SELECT l.doc_id, count(*) AS n FROM l JOIN later ON l.doc_id = later.doc_id AND l.p = later.p GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text, CAST(coalesce(n.n, 0) AS INTEGER) AS lines_removed
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN n ON d.doc_id = n.doc_id
"""
