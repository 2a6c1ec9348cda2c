"""Line-first quality rules: failing lines go, then documents that lost too much.

Every line that holds a word is held against three rules.

* Punctuation: it holds no letter or digit, more than a tenth of it are symbols, it ends in an ellipsis
  or in repeated marks, or it has at most three words and no closing mark.
* Navigation: it is short and is cut by two or more menu separators, or starts like a menu.
* Boilerplate: it is short and holds a stock phrase of web pages.

Menu words and stock phrases are English, German, French and Spanish; other languages have the rules that go by signs.

A document is rejected by two base rules on the whole text (too few words, or too many words in
repeated five-word windows) or if its failing lines hold more than `MOST_LOST` per cent of its text.

Everything is expressions on one row: no shuffle, and a line or a text may be of any length. Windows
are compared by 64-bit hashes of their five words in turn.

Defined results: a null text has no words and is rejected by the base rules; so is an empty one; equal
rows give equal rows; a null `doc_id` stays null; other columns are carried by `cleaned`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.llm.common import bind, packed, quoted, text_or_empty, words_of

LEAST_WORDS, MOST_REPEATED, MOST_LOST = 10, 20, 50
WINDOW = 5
SYMBOLS = "#*$%&|<>"
NOT_SYMBOL = "[^#*$%&|<>]+"
HAS_WORD = r"[^ \t-\r]"
HAS_LETTER = r"[\p{L}\p{N}]"
BAD_END = r"(?:\.\.\.|…|[!?]{2})[ \t-\r]*\z"
GOOD_END = "[.!?:;。！？…\"'”’»)\\]][ \\t-\\r]*\\z"
FEW_WORDS = r"\A[ \t-\r]*[^ \t-\r]++(?:[ \t-\r]++[^ \t-\r]++){0,2}[ \t-\r]*\z"
SHORT = r"\A[ \t-\r]*[^ \t-\r]++(?:[ \t-\r]++[^ \t-\r]++){0,24}[ \t-\r]*\z"
SHORT_CHARS = 240
# Words that open a menu line, in English, German, French and Spanish.
MENU_WORDS = (
    "home", "menu", "log ?in", "sign (?:in|up)", "search", "next", "previous", "back to top", "skip to",
    "startseite", "anmelden", "registrieren", "suche", "weiter", "zurück", "nach oben", "zum inhalt",
    "accueil", "connexion", "se connecter", "s'inscrire", "rechercher", "suivant", "précédent", "haut de page", "aller au contenu",
    "inicio", "iniciar sesión", "registrarse", "buscar", "siguiente", "anterior", "volver arriba", "ir al contenido",
)
# Separators of menu entries.
NAVIGATION = (
    r"(?:[|»›•→·][^|»›•→·]*){2,}"
    rf"|(?iu)\A[ \t-\r]*(?:{'|'.join(MENU_WORDS)})(?![\p{{L}}\p{{N}}])[^.]*\z"
)
# Stock phrases of web pages, in the same languages.
STOCK_PHRASES = (
    "all rights reserved", "privacy policy", "cookie policy", "use of cookies", "uses cookies", "terms of (?:use|service)",
    "terms and conditions", "enable javascript", "lorem ipsum", "click here", "read more", "subscribe to our", "sign up for",
    "share (?:this|on)", "follow us",
    "alle rechte vorbehalten", "datenschutzerklärung", "cookie-richtlinie", "verwendet cookies", "nutzungsbedingungen",
    "allgemeine geschäftsbedingungen", "javascript aktivieren", "hier klicken", "weiterlesen", "newsletter abonnieren", "folgen sie uns",
    "tous droits réservés", "politique de confidentialité", "politique de cookies", "utilise des cookies", "conditions d'utilisation",
    "conditions générales", "activer javascript", "cliquez ici", "lire la suite", "abonnez-vous", "suivez-nous",
    "todos los derechos reservados", "política de privacidad", "política de cookies", "utiliza cookies", "condiciones de uso",
    "términos y condiciones", "activar javascript", "haga clic aquí", "leer más", "suscríbete a", "síguenos",
)
BOILERPLATE = rf"(?iu){'|'.join(STOCK_PHRASES)}"


def symbol_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, NOT_SYMBOL, ""))


def repeated_words(words: Column) -> Column:
    """Words in five-word windows that the array holds twice or more, the first ones included."""

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])

    def covered(starts: Column) -> Column:
        reach = F.transform(starts, lambda s, k: F.least(F.lit(WINDOW), F.get(starts, k + 1) - s))
        return F.aggregate(reach, F.lit(0), lambda total, r: total + r)

    def in_order(found: Column) -> Column:
        def twin(e: Column, k: Column) -> Column:
            same = F.coalesce(F.get(found, k - 1)["h"] == e["h"], F.lit(False))
            return same | F.coalesce(F.get(found, k + 1)["h"] == e["h"], F.lit(False))

        starts = F.transform(F.filter(found, twin), lambda e: e["i"])
        return bind(F.sort_array(starts), covered)

    def counted(hashes: Column) -> Column:
        places = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            bind(places, in_order)
        )

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), window)
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(bind(hashes, counted))


def line_fails(line: Column) -> Column:
    """Whether a line with a word breaks one of the three rules."""
    symbols = symbol_count(line) * 10 > F.length(line)
    punctuation = ~line.rlike(HAS_LETTER) | symbols | line.rlike(BAD_END) | (line.rlike(FEW_WORDS) & ~line.rlike(GOOD_END))
    short = (F.length(line) <= SHORT_CHARS) & line.rlike(SHORT)
    return punctuation | (short & (line.rlike(NAVIGATION) | line.rlike(BOILERPLATE)))


def assess(text: Column) -> Column:
    """Struct of all counts, the two verdicts and the cleaned text of one text."""

    def of_lines(lines: Column) -> Column:
        real = F.filter(lines, lambda x: x["word"])
        left = F.filter(lines, lambda x: ~x["bad"])
        chars = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda t, x: t + F.length(x["line"]))
        texts = lambda a: F.transform(a, lambda x: x["line"])
        return F.struct(
            F.size(texts(real)).cast("long").alias("n_lines"),
            (F.size(real) - F.size(F.array_distinct(texts(real)))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(lines, lambda x: x["bad"])).cast("long").alias("n_bad_lines"),
            (chars(left) * 100 < chars(lines) * (100 - MOST_LOST)).alias("lost"),
            F.array_join(texts(left), "\n").alias("cleaned"),
        )

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
        )

    def judged(line: Column) -> Column:
        word = line.rlike(HAS_WORD)
        return F.struct(line.alias("line"), word.alias("word"), (word & line_fails(line)).alias("bad"))

    parts = F.struct(
        bind(words_of(text), of_words).alias("w"),
        bind(F.transform(F.split(text, "\n"), judged), of_lines).alias("l"),
        symbol_count(text).cast("long").alias("n_symbols"),
    )

    def verdict(p: Column) -> Column:
        n = p["w"]["n_words"]
        failed = (n < LEAST_WORDS) | (p["w"]["n_repeat_words"] * 100 > n * MOST_REPEATED)
        return F.struct(
            n.alias("n_words"), p["w"]["word_chars"].alias("word_chars"), p["n_symbols"].alias("n_symbols"),
            p["l"]["n_dup_lines"].alias("n_dup_lines"), p["w"]["n_repeat_words"].alias("n_repeat_words"),
            failed.alias("base_failed"), (~failed & ~p["l"]["lost"]).alias("kept"),
            p["l"]["n_lines"].alias("n_lines"), p["l"]["n_bad_lines"].alias("n_bad_lines"),
            p["l"]["cleaned"].alias("cleaned"),
        )

    return bind(parts, verdict)


def score(documents: DataFrame) -> DataFrame:
    """`doc_id`, the counts and verdicts of every document, and its text without failing lines."""
    # The generator keeps the assessment a single expression, computed once per row.
    found = documents.select("doc_id", F.explode(F.array(assess(text_or_empty()))).alias("q"))
    return found.select("doc_id", "q.*")


def cleaned(documents: DataFrame) -> DataFrame:
    """The kept documents with their cleaned text (and `n_chars`, if there is one); all columns stay."""
    columns = documents.columns
    text = text_or_empty("row.text")
    kept = bind(assess(text), lambda q: F.when(q["kept"], F.array(q["cleaned"])).otherwise(F.slice(F.array(q["cleaned"]), 1, 0)))
    rows = packed(documents).select("row", F.explode(kept).alias("text"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rows.select(*[new.get(c, F.col(f"row.{quoted(c)}")).alias(c) for c in columns])
