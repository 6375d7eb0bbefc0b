"""Line-first cleaning: rules for each line, then a verdict on what is left of the document.

A line fails when it is navigation (nothing but menu words, or many short parts
between separators), boilerplate (cookie, copyright, sign-up phrases, one for
every 40 words of the line; English, French, German and Spanish, ASCII letters
in either case), or when its punctuation is not that of prose (a fifth or more of its characters are
symbols, it shouts, or it is one word again and again). A document is rejected
when failed lines hold more than half of its word characters. Licence lines
and the like cost a clean document one line, not its place.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from touchline.llm.tables import keyed_texts, query, rest_of, table, with_rest
from touchline.llm.text import Hasher, Texts, slices, windows, within

# fixed values of the base rules
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50

# fixed values of the line rules
SEPARATORS = b"|>/"
MARKS = b"!#*$%&|<>=_~^{}[]@\\+"
NAVIGATION = (
    "home", "menu", "next", "previous", "login", "log in", "sign in", "sign up", "register", "search", "contact us",
    "about us", "site map", "sitemap", "skip to content", "back to top", "read more", "share", "tweet", "reply",
    "accueil", "suivant", "précédent", "connexion", "rechercher", "contactez-nous", "plan du site", "aller au contenu",
    "haut de page", "lire la suite", "partager",
    "startseite", "menü", "weiter", "zurück", "anmelden", "registrieren", "suche", "kontakt", "impressum", "zum inhalt springen",
    "nach oben", "mehr lesen", "weiterlesen", "teilen",
    "inicio", "menú", "siguiente", "anterior", "iniciar sesión", "buscar", "contacto", "mapa del sitio", "ir al contenido",
    "volver arriba", "leer más", "compartir",
)
BOILERPLATE = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy", "uses cookies",
    "accept cookies", "enable javascript", "click here", "subscribe to our newsletter", "lorem ipsum",
    "tous droits réservés", "politique de confidentialité", "conditions générales", "mentions légales", "utilise des cookies",
    "accepter les cookies", "activer javascript", "cliquez ici", "abonnez-vous à notre newsletter",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "allgemeine geschäftsbedingungen", "verwendet cookies",
    "cookies akzeptieren", "javascript aktivieren", "hier klicken", "newsletter abonnieren",
    "todos los derechos reservados", "política de privacidad", "política de cookies", "términos de uso", "condiciones de uso",
    "utiliza cookies", "aceptar cookies", "habilitar javascript", "haga clic aquí", "suscríbase a nuestro boletín",
)
BETWEEN = "(?:[ \t-\r>.:,|]|»|·|•)"
#: words of a line that one boilerplate phrase speaks for
PHRASE_WORDS = 40
_ENTRY = "|".join(map(re.escape, NAVIGATION))
NAV_LINE = re.compile(f"{BETWEEN}*(?:{_ENTRY})(?:{BETWEEN}+(?:{_ENTRY}))*{BETWEEN}*".encode())
BOILER = re.compile("|".join(map(re.escape, BOILERPLATE)).encode())
MENU_PARTS = 3
MAX_MARKS = 20
MAX_SAME = 50
MAX_LOST = 50

RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_lines long, n_bad_lines long, lost_chars long, kept boolean, cleaned string"
)


def _table(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


_SYMBOL, _SEPARATOR, _MARK = _table(SYMBOLS), _table(SEPARATORS), _table(MARKS)
_UPPER = _table(bytes(range(65, 91)))
_SMALL = _table(bytes(range(97, 123)))


def _before(mask: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(mask)))


def _repeats(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: is its key met twice or more in its text, and was it met before."""
    order = np.lexsort((np.arange(len(key)), key, owner))
    same = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    later = np.zeros(len(key), bool)
    many = np.zeros(len(key), bool)
    later[order[1:][same]] = True
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    return many, later


def measure(texts: Texts) -> dict[str, np.ndarray | list[bytes]]:
    """All counts and the verdict for each text."""
    data, n = texts.data, len(texts)
    hashes = Hasher(data)
    start, end, first = texts.words()
    n_words = np.diff(first)
    word_hash = hashes.spans(start, end)
    points = texts.code_points()
    solid = _before(points[end] - points[start])
    word_chars = np.diff(solid[first])

    key, at = windows(word_hash, first, 3)
    many, _ = _repeats(key, within(first)[at])
    covered = np.zeros(len(start) + 3, bool)
    for j in range(3):
        covered[at[many] + j] = True
    n_repeat = np.diff(_before(covered)[first])

    line_start, line_end, line_first = texts.lines()
    owner = within(line_first)
    w0, w1 = np.searchsorted(start, line_start), np.searchsorted(start, line_end)
    words = w1 - w0
    line_chars = solid[w1] - solid[w0]
    used = words > 0
    dup = np.zeros(len(line_start), bool)
    dup[used] = _repeats(hashes.spans(line_start[used], line_end[used]), owner[used])[1]

    def per_line(mask: np.ndarray) -> np.ndarray:
        sums = _before(mask)
        return sums[line_end] - sums[line_start]

    marks, upper, small = per_line(_MARK[data]), per_line(_UPPER[data]), per_line(_SMALL[data])
    menu = (per_line(_SEPARATOR[data]) >= MENU_PARTS) & (words <= 3 * (per_line(_SEPARATOR[data]) + 1))
    symbol = 100 * marks > MAX_MARKS * np.maximum(line_chars, 1)
    shout = (per_line(data == 33) * 4 >= words) & (words >= 8) & (upper > small)
    again = np.concatenate(([0], np.cumsum(np.concatenate(([False], word_hash[1:] == word_hash[:-1])))))
    inner = np.where(words > 1, again[w1] - again[np.minimum(w0 + 1, w1)], 0)
    same = (words >= 8) & (100 * inner > MAX_SAME * words)
    bad = used & (menu | symbol | shout | same)
    lower = data | (_UPPER[data].astype(np.uint8) << 5)
    for i in np.flatnonzero(used & ~bad):
        line = lower[line_start[i] : line_end[i]].tobytes()
        bad[i] = PHRASE_WORDS * len(BOILER.findall(line)) >= words[i] or NAV_LINE.fullmatch(line) is not None

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(values)))[line_first])

    lost = per_text(line_chars * bad)
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEATED * n_words)
    cleaned = []
    for i in range(n):
        a, b = line_first[i], line_first[i + 1]
        if bad[a:b].any():
            cleaned.append(b"\n".join(data[line_start[k] : line_end[k]].tobytes() for k in range(a, b) if not bad[k]))
        else:
            cleaned.append(texts.text(i))
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": np.diff(_before(_SYMBOL[data])[texts.off]),
        "n_dup_lines": per_text(dup),
        "n_repeat_words": n_repeat,
        "base_failed": failed,
        "n_lines": np.diff(line_first),
        "n_bad_lines": per_text(bad),
        "lost_chars": lost,
        "kept": ~failed & (100 * lost <= MAX_LOST * word_chars),
        "cleaned": cleaned,
    }


def line_first_cleaning(docs: DataFrame, key: str = "doc_id", text: str = "text", rest: Sequence[str] = ()) -> DataFrame:
    """Counts, verdict and cleaned text of every document.

    Null and empty texts have no words and fail the base rule. Equal rows give
    equal rows; a null key stays null. Other columns of the input are not read,
    but for those in ``rest``, which come back as a struct of that name. One scan without a shuffle; a task holds a few MB of text, or one document.
    """

    def run(batches):
        for rows, texts in slices(batches, "text"):
            out = measure(texts)
            cleaned = pa.array(out.pop("cleaned"), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *map(pa.array, out.values()), cleaned, *rest_of(rows)], kind.names)

    chosen = keyed_texts(docs, key, text, rest)
    kind = with_rest(RESULT, chosen)
    return chosen.mapInArrow(run, kind)


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), win AS (
  SELECT doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c >= 2) GROUP BY doc_id
), ln AS (
  SELECT doc_id, i, l[i] AS s, regexp_extract_all(l[i], '[^\x20\x09-\x0D]+') AS lw
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)
), lm AS (
  SELECT doc_id, s, lw, len(lw) AS words, len(array_to_string(lw, '')) AS chars,
         len(regexp_replace(s, '[^|>/]', '', 'g')) AS seps,
         len(regexp_replace(s, '[^!#*$%&|<>=_~^{}\[\]@\\+]', '', 'g')) AS marks,
         len(regexp_replace(s, '[^!]', '', 'g')) AS bangs,
         len(regexp_replace(s, '[^A-Z]', '', 'g')) AS uppers, len(regexp_replace(s, '[^a-z]', '', 'g')) AS smalls,
         len(list_filter(range(2, len(lw) + 1), lambda j: lw[j] = lw[j - 1])) AS again,
         row_number() OVER (PARTITION BY doc_id, s ORDER BY i) AS nth
  FROM ln
), lv AS (
  SELECT *, words > 0 AND (
      (seps >= @PARTS AND words <= 3 * (seps + 1)) OR 100 * marks > @MARKS * greatest(chars, 1)
      OR (bangs * 4 >= words AND words >= 8 AND uppers > smalls) OR (words >= 8 AND 100 * again > @SAME * words)
      OR regexp_matches(low, '^@SEP*(?:@NAV)(?:@SEP+(?:@NAV))*@SEP*$')
      OR @PHRASE * len(regexp_extract_all(low, '@BOILER')) >= words) AS bad
  FROM (SELECT *, translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM lm)
), ls AS (
  SELECT doc_id, sum(CASE WHEN words > 0 AND nth > 1 THEN 1 ELSE 0 END) AS n_dup, count(*) AS n_lines,
         sum(bad::INT) AS n_bad, sum(CASE WHEN bad THEN chars ELSE 0 END) AS lost
  FROM lv GROUP BY doc_id
), m AS (
  SELECT doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, n_dup AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, n_lines, n_bad, lost
  FROM d JOIN ls USING (doc_id) LEFT JOIN rep USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       n_bad::BIGINT AS n_bad_lines, lost::BIGINT AS lost_chars,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost <= @LOST * word_chars AS kept
FROM m
"""
_VALUES = {"PARTS": MENU_PARTS, "MARKS": MAX_MARKS, "SAME": MAX_SAME, "LOST": MAX_LOST}
for _name, _value in (_VALUES | {"SEP": BETWEEN, "NAV": "|".join(NAVIGATION), "BOILER": "|".join(BOILERPLATE), "PHRASE": PHRASE_WORDS}).items():
    SQL = SQL.replace(f"@{_name}", str(_value))


@query("op6_line_first_cleaning", SQL)
def op6(spark, folder):
    return line_first_cleaning(table(spark, folder, "documents")).drop("cleaned", "n_lines")
