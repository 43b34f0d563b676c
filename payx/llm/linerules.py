"""Quality rules, line first.

Every line is judged on its own by punctuation, navigation, boilerplate, link and number rules; failing lines are
removed; a document that loses too much of its text with them is rejected. Only DataFrame functions are used. Most
rules ask for marks, links and numbers and hold in any language; the stock phrases are those of four languages. Ends of
sentences are those of many scripts. A long line without one may be wrapped prose: it is kept with the lines that
follow at once, if one of them ends a sentence and none of those before it breaks a rule.

Null text has no words and no lines; it fails the base rules, as does any text of fewer than MIN_WORDS words. Repeated
rows each have a row; other columns than doc_id and text are ignored; texts are judged whole, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payx.llm.common import BLANKS, WORD

# Base thresholds, characters and words of the rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "click here", "subscribe to our", "sign up for", "enable javascript", "share this", "read more", "powered by",
    "alle rechte vorbehalten", "datenschutzerklärung", "allgemeine geschäftsbedingungen", "hier klicken", "newsletter abonnieren", "jetzt anmelden", "weiterlesen",
    "tous droits réservés", "politique de confidentialité", "mentions légales", "conditions d'utilisation", "cliquez ici", "abonnez-vous à", "lire la suite",
    "todos los derechos reservados", "política de privacidad", "política de cookies", "aviso legal", "condiciones de uso", "haga clic aquí", "suscríbete a", "leer más",
)
NAVIGATION = (
    "home", "next", "previous", "back to top", "menu", "skip to content", "log in", "login", "sitemap", "contact us", "about us",
    "startseite", "weiter", "zurück", "nach oben", "anmelden", "impressum", "kontakt", "über uns",
    "accueil", "suivant", "précédent", "haut de page", "connexion", "plan du site", "contactez-nous", "à propos",
    "inicio", "siguiente", "anterior", "volver arriba", "iniciar sesión", "mapa del sitio", "contacto", "quiénes somos",
)
#: A line fails for symbols if they are more than this share of its words, for separators if bars are, for shouting if
#: double exclamation marks are, for links if they are, and for numbers if they are.
SYMBOL_SHARE, BAR_SHARE, SHOUT_SHARE, LINK_SHARE, NUMBER_SHARE = 0.2, 0.2, 0.2, 0.25, 0.5
#: A document is rejected if failing lines hold more than this share of its characters.
MAX_LOSS = 0.5


def has_word(text: Column) -> Column:
    return text.rlike(WORD)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS, -1), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Number of words in 3-word windows that the text holds twice or more, the first occurrence included.

    Windows are put in order by their hash and, where that is equal, their words; those equal to a neighbour in that
    order recur. A word is counted once, in whichever window it is reached first: a window adds the words that the
    recurring one before it left out. Texts whose hashes all differ have no recurring window and skip the sorting.
    """
    n = F.size(words) - 2
    part = lambda i: [F.get(words, i + k) for k in range(3)]
    hashes = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*part(i)))).otherwise(F.array().cast("array<bigint>"))

    def count(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), F.concat_ws(" ", *part(i)).alias("w"), i.alias("i"))))
        # Neighbours in order, as three parallel arrays.
        none = F.array(F.lit(None).cast(ELEMENT))
        near = lambda s: F.arrays_zip(s.alias("x"), F.concat(none, s).alias("p"), F.concat(F.slice(s, 2, F.size(s)), none).alias("q"))
        same = lambda t, k: F.coalesce((t["x"]["h"] == t[k]["h"]) & (t["x"]["w"] == t[k]["w"]), F.lit(False))
        recur = bind(ordered, lambda s: F.transform(F.filter(near(s), lambda t: F.coalesce(t["x"]["h"].isNotNull(), F.lit(False)) & (same(t, "p") | same(t, "q"))), lambda t: t["x"]["i"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(F.sort_array(recur), start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"])

    return bind(hashes, lambda h: F.when(F.size(h) == F.size(F.array_distinct(h)), F.lit(0)).otherwise(count(h))).cast("long")


ELEMENT = "struct<h:bigint,w:string,i:int>"


def bind(value: Column, use) -> Column:
    """use(value), with value computed once for each row."""
    return F.transform(F.array(value), use)[0]


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, body, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of every row."""
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"))
    rows = rows.withColumn("words", words_of(F.col("body")))
    lines = F.filter(F.split("body", "\n", -1), has_word)
    rows = rows.select(
        "doc_id",
        "body",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("body", BLANKS, "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    return rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


# Patterns over a line in lower case, read alike by Java's and RE2's regular expressions.
PHRASE = "(^|[^a-z])(" + "|".join(BOILERPLATE) + ")"
ENTRY = r"^\W*(" + "|".join(NAVIGATION) + r")\W*$"
#: A word that ends as a sentence does: full stop, question mark, colon, ellipsis or a single exclamation mark, closing
#: marks behind it allowed; or a mark of other scripts, wherever it stands. Thai and Lao have none and pass.
SENTENCE_END = r"[.?:;…][\x22')\]»”]*(\s|$)|[^!]!(\s|$)|[。！？｡．｣؟۔।॥።៕។]|[ก-๛ກ-ໟ]"
#: A line of so many characters may be wrapped, and go on in the next.
WRAPPED = 30
LINK = r"https?://|www\."
NUMBER = r"(^|[\s(])[0-9][0-9.,:/()%+-]*"


def _breaks(line: Column) -> Column:
    """The first rule that a line breaks by what it holds, else null."""
    low = F.lower(line)
    count = lambda pattern: F.regexp_count(line, F.lit(pattern))
    many = lambda pattern, share: line.rlike(pattern) & (count(pattern) > share * count(WORD))
    marks = many("!!", SHOUT_SHARE) | many("[#*$%&<>]", SYMBOL_SHARE)
    navigation = many(r"\|", BAR_SHARE) | low.rlike(ENTRY)
    return F.when(low.rlike(PHRASE), "boilerplate").when(navigation, "navigation").when(many(LINK, LINK_SHARE), "links").when(many(NUMBER, NUMBER_SHARE), "numbers").when(marks, "punctuation")


def line_fails(line: Column) -> Column:
    """The first rule failed by a line that stands alone, else null.

    boilerplate: a stock phrase. navigation: many separator bars, or nothing but a menu word. links: many of them.
    numbers: most words begin as one. punctuation: no word of the line ends as a sentence does, or the line has shouting marks at every
    fifth word, or many symbols. Words are counted only in lines that have such marks.
    """
    return F.coalesce(_breaks(line), F.when(~line.rlike(SENTENCE_END), "punctuation"))


def line_class(line: Column) -> Column:
    """E: the line is good by itself. C: it lacks but the end of a sentence, and is long enough to go on. B: it is bad."""
    return F.when(_breaks(line).isNotNull(), "B").when(line.rlike(SENTENCE_END), "E").when(F.length(line) >= WRAPPED, "C").otherwise("B")


def clean_lines(body: Column) -> Column:
    """Struct of the cleaned text and the number of characters of lines with words, all and removed.

    The classes of all lines make one string, which is cut behind every E and B: the lines of a part are good if it
    ends with E.
    """

    def judged(lines: Column) -> Column:
        parts = F.split(F.array_join(F.transform(lines, line_class), ""), "(?<=[EB])", -1)
        good = F.flatten(F.transform(parts, lambda p: F.array_repeat(p.endswith("E"), F.length(p))))
        return F.filter(F.zip_with(lines, good, lambda x, g: F.struct(x.alias("line"), (~g).alias("bad"))), lambda r: has_word(r["line"]))

    def summed(rows: Column) -> Column:
        good = F.filter(rows, lambda r: ~r["bad"])
        size = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda n, r: n + F.length(r["line"]))
        return F.struct(F.array_join(F.transform(good, lambda r: r["line"]), "\n").alias("text"), size(rows).alias("chars"), (size(rows) - size(good)).alias("lost"))

    return bind(bind(F.split(body, "\n", -1), judged), summed)


def filtered(docs: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """Base columns of every row, cleaned text, chars_lost and the verdict kept."""
    rows = base_rules(docs).withColumn("c", clean_lines(F.col("body")))
    kept = ~F.col("base_failed") & (F.col("c.lost") <= max_loss * F.col("c.chars"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("c.text").alias("cleaned"), F.col("c.lost").alias("chars_lost"), kept.alias("kept"))


def oracle() -> str:
    """The same in DuckDB SQL, without the cleaned text."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    count = lambda pattern: f"len(regexp_extract_all(x, {quote(pattern)}))"
    many = lambda pattern, share: f"{count(pattern)} > {share} * {count(WORD)}"
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
    w AS (SELECT doc_id, body, list_filter(regexp_split_to_array(body, '{BLANKS}'), lambda x: x <> '') AS words, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
    win AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
    rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win),
    hit AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM rep, range(3) t(j) WHERE rep.n > 1 GROUP BY 1),
    ln AS (SELECT doc_id, i, whole[i] AS x FROM (SELECT doc_id, whole, unnest(range(1, len(whole) + 1)) AS i FROM (SELECT doc_id, string_split(body, chr(10)) AS whole FROM d))),
    broken AS (SELECT doc_id, i, x, regexp_matches(lower(x), {quote(PHRASE)}) OR {many("[|]", BAR_SHARE)} OR regexp_matches(lower(x), {quote(ENTRY)}) OR {many(LINK, LINK_SHARE)} OR {many(NUMBER, NUMBER_SHARE)}
      OR {many("!!", SHOUT_SHARE)} OR {many("[#*$%&<>]", SYMBOL_SHARE)} AS breaks, regexp_matches(x, {quote(SENTENCE_END)}) AS ends FROM ln),
    stops AS (SELECT *, min(CASE WHEN breaks OR ends OR length(x) < {WRAPPED} THEN i END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS stop FROM broken),
    judged AS (SELECT a.doc_id, a.x, NOT coalesce(b.ends AND NOT b.breaks, false) AS bad FROM stops a LEFT JOIN broken b ON b.doc_id = a.doc_id AND b.i = a.stop WHERE regexp_matches(a.x, '{WORD}')),
    loss AS (SELECT doc_id, sum(length(x))::BIGINT AS chars, coalesce(sum(length(x)) FILTER (bad), 0)::BIGINT AS lost FROM judged GROUP BY 1),
    base AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(body, '{BLANKS}', '', 'g'))::BIGINT AS word_chars, len(regexp_extract_all(body, '[{SYMBOLS}]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(hit.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN hit USING (doc_id)),
    v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM base)
    SELECT v.*, coalesce(lost, 0) AS chars_lost, NOT base_failed AND coalesce(lost, 0) <= {MAX_LOSS} * coalesce(chars, 0) AS kept FROM v LEFT JOIN loss USING (doc_id)
    """
