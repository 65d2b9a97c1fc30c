"""Op 6: quality rules, line-first cleaning.

Words are runs without space, tab, line and page breaks; lines are split at line feeds. Every line with a word
is judged by itself:

* punctuation: a short line (under ``SHORT_LINE`` words; ten code points count as a word at least, for scripts without
  spaces) that does not end in a closing mark of any script; or too many words with a symbol, or too many ending in
  two exclamation marks;
* navigation: too many separators (``|``, ``>``, ``/`` and the like as words of their own), too many links or mail
  addresses, or a line of ``MENU_WORDS`` words without a closing mark, nearly all with a capital;
* boilerplate: phrases of the web's and licences' fixed wording make up ``BOILERPLATE`` of the line's words or more (a
  sentence about such a phrase stays), or one word makes up most of a long line.

Failing lines are removed, and a document that loses more than ``MOST_LOST`` of its word characters is
rejected. Before that, the base rules fail texts of under 50 words and texts of which over half the words
stand in repeated three-word windows. Lines and windows are compared by 64-bit hashes within one text. Phrases are
found in lower case of A-Z; letters beyond ASCII as they are written below.

Null and empty texts have no words and fail the base rules; their clean text is empty. Texts of any length
are judged whole: bytes are read a megabyte at a time (cut between words), and the numbers kept of each word, not of
each byte, are what grows with a text. Rows are independent: repeated rows, empty tables and other columns pass through unchanged.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import GAP, add_fields, blocks, col, mixed, pieces, ship, table, utf8, word_hashes, word_spans
from feedloom.llm.quality import row_shares

LEAST_WORDS, MOST_REPEATED = 50, 50  # words; per cent of words
SHORT_LINE, SYMBOL_WORDS, BANG_WORDS, SEPARATORS, ONE_WORD, LONG_LINE = 4, 0.3, 0.3, 0.2, 0.5, 10
LINKS, MENU_WORDS, CAPITALS, BOILERPLATE = 0.3, (3, 12), 0.8, 1 / 3
MOST_LOST = 0.4
# Wording of notices, menus and licences in the languages of the tables.
PHRASES = tuple(p.encode() for p in (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies",
    "accept all cookies", "uses cookies", "log in", "sign in", "sign up", "subscribe to our newsletter", "click here",
    "back to top", "enable javascript", "read more", "share this", "licensed under", "released under", "mit license",
    "apache license", "general public license", "creative commons",
    "alle rechte vorbehalten", "cookies akzeptieren", "verwendet cookies", "jetzt anmelden", "newsletter abonnieren", "hier klicken",
    "mehr lesen", "nach oben", "lizenziert unter",
    "tous droits réservés", "conditions d'utilisation", "politique de confidentialité", "accepter les cookies", "cliquez ici",
    "lire la suite", "haut de page", "sous licence",
    "todos los derechos reservados", "política de privacidad", "aceptar cookies", "términos de uso", "haga clic aquí",
    "leer más", "volver arriba", "bajo la licencia", "©"))
FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bad_lines", "base_failed", "kept", "clean_text"]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*b"#*$%&|<>"]] = True
_CLOSING = np.zeros(128, bool)
_CLOSING[[*b".!?\"')]:;"]] = True
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[*b"|>/-*<"]] = True
_INNER = np.zeros(256, bool)  # bytes inside names and numbers: a phrase has none right before or behind it
_INNER[[*b"0123456789abcdefghijklmnopqrstuvwxyz_"]] = True
_INNER[128:] = True


def code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The code points whose first bytes stand at ``at``."""
    byte = lambda k: data[np.minimum(at + k, len(data) - 1)].astype(np.int64) & 0x3F
    one = data[at].astype(np.int64)
    two, three, four = ((one & 31) << 6) | byte(1), ((one & 15) << 12) | (byte(1) << 6) | byte(2), \
        ((one & 7) << 18) | (byte(1) << 12) | (byte(2) << 6) | byte(3)
    return np.select([one < 0x80, one < 0xE0, one < 0xF0], [one, two, three], four)


def of_kind(points: np.ndarray, kinds: set[str]) -> np.ndarray:
    """Whether each code point's Unicode category is one of ``kinds``."""
    some, at = np.unique(points, return_inverse=True)
    return np.array([unicodedata.category(chr(p)) in kinds for p in some.tolist()], bool)[at]


def word_facts(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Of every word its start, end, row, code points, hash, and whether it has a symbol; and the symbols of each row."""
    parts, n_symbols, at = [], np.zeros(len(offsets) - 1, np.int64), 0
    for part, offs, which in pieces(data, offsets, GAP):
        starts, ends, rows = word_spans(part, offs)
        points = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
        symbols = np.concatenate([[0], np.cumsum(_SYMBOL[part])])
        n_symbols[which] += np.diff(symbols[offs])
        parts.append((starts + at, ends + at, which[rows], points[ends] - points[starts], word_hashes(part, starts, ends),
                      symbols[ends] > symbols[starts]))
        at += len(part)
    kinds = (np.int64, np.int64, np.int64, np.int64, np.uint64, bool)
    return [np.concatenate([np.zeros(0, kind), *(p[k] for p in parts)]) for k, kind in enumerate(kinds)], n_symbols


def phrase_words(raw: bytes, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each word belongs to one of the phrases; texts lie side by side, so a phrase must lie in one line."""
    lower, inside = raw.lower(), np.zeros(len(starts), bool)
    for phrase in PHRASES:
        found = lower.find(phrase)
        while found >= 0:
            end = found + len(phrase)
            i, j = np.searchsorted(starts, [found, end - 1], "right") - 1
            alone = (found == starts[i] or not _INNER[lower[found - 1]]) and (end == ends[j] or not _INNER[lower[end]])
            if at[i] == at[j] and alone:
                inside[i:j + 1] = True
            found = lower.find(phrase, found + 1)
    return inside


def link_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each word holds ``://``, begins with ``www.`` or has an ``@`` inside."""
    out = np.zeros(len(starts), bool)
    slashes = np.flatnonzero((data[:-2] == 58) & (data[1:-1] == 47) & (data[2:] == 47))
    signs = np.flatnonzero(data == 64)
    for at, size, least in ((slashes, 3, 0), (signs, 1, 1)):
        k = np.searchsorted(starts, at, "right") - 1
        k = k[(at >= starts[k] + least) & (at + size <= ends[k] - least)] if len(starts) else k
        out[k] = True
    www = ends - starts > 4
    for k, letter in enumerate(b"www"):
        www[www] = (data[starts[www] + k] | 32) == letter
    www[www] = data[starts[www] + 3] == 46
    return out | www


def judge(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Counts and verdict of each text; and of all lines with a word: the start, and whether the line fails."""
    n, raw = len(offsets) - 1, data.tobytes()
    (starts, ends, rows, chars, hashes, with_symbol), n_symbols = word_facts(data, offsets)
    words = np.bincount(rows, minlength=n)
    out = {"n_words": words, "word_chars": np.bincount(rows, chars, n).astype(np.int64), "n_symbols": n_symbols}

    triple = mixed(mixed(mixed(hashes[:-2]) + hashes[1:-1]) + hashes[2:])
    same = np.flatnonzero(rows[:-2] == rows[2:]) if len(rows) > 2 else np.zeros(0, np.int64)
    order = same[np.lexsort((triple[same], rows[same]))]
    twin = (triple[order[1:]] == triple[order[:-1]]) & (rows[order[1:]] == rows[order[:-1]])
    again = np.unique(np.concatenate([order[1:][twin], order[:-1][twin]]))
    covered = np.zeros(len(starts), bool)
    for k in range(3):
        covered[again + k] = True
    out["n_repeat_words"] = np.bincount(rows[covered], minlength=n)

    # Lines: from a text's start or a line feed to the next line feed or the text's end.
    feeds = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1], feeds + 1]))
    line_start = line_start[line_start < len(data)]
    line = np.searchsorted(line_start, starts, "right") - 1  # of each word
    lines, first, line_words = np.unique(line, return_index=True, return_counts=True)  # those with a word
    row = rows[first]
    bounds = np.append(line_start, len(data))
    stop = bounds[lines + 1]
    stop = stop - (data[stop - 1] == 10)
    line_hash = np.fromiter((hash(raw[p:q]) for p, q in zip(line_start[lines].tolist(), stop.tolist())), np.int64, len(lines))
    distinct, _, _ = row_shares(line_hash, row, n)
    out["n_dup_lines"] = np.bincount(row, minlength=n) - distinct.astype(np.int64)

    at = np.repeat(np.arange(len(lines)), line_words)  # the line of each word, numbered as ``lines``
    size = np.maximum(line_words, 1)
    bang = (data[ends - 1] == 33) & (data[np.maximum(ends - 2, 0)] == 33) & (ends - starts > 1)
    separator = (ends - starts == 1) & _SEPARATOR[data[starts]]
    share = lambda mark: np.bincount(at[mark], minlength=len(lines)) / size
    last = ends[first + line_words - 1] - 1
    for _ in range(3):  # to the first byte of the last code point
        last = last - ((data[last] & 0xC0) == 0x80)
    points = code_points(data, last)
    closed = _CLOSING[np.minimum(points, 127)] & (points < 128)
    beyond = points >= 128
    closed[beyond] = of_kind(points[beyond], {"Po", "Pe", "Pf", "Pi"})
    _, _, top = row_shares(hashes, at, len(lines))
    length = np.maximum(line_words, np.bincount(at, chars, len(lines)) // 10)
    bad = (~closed & (length < SHORT_LINE)) | (share(with_symbol) > SYMBOL_WORDS) | (share(bang) > BANG_WORDS)
    bad |= (share(separator) > SEPARATORS) | (share(link_words(data, starts, ends)) > LINKS)
    menu = ~closed & (line_words >= MENU_WORDS[0]) & (line_words <= MENU_WORDS[1])
    some = np.flatnonzero(menu[at])
    capital = some[of_kind(code_points(data, starts[some]), {"Lu", "Lt"})]
    bad |= menu & (np.bincount(at[capital], minlength=len(lines)) / size >= CAPITALS)
    bad |= (line_words >= LONG_LINE) & (top / size > ONE_WORD)
    bad |= share(phrase_words(raw, starts, ends, at)) >= BOILERPLATE
    lost = np.bincount(rows, chars * bad[at], n)
    out["n_bad_lines"] = np.bincount(row[bad], minlength=n)
    out["base_failed"] = (words < LEAST_WORDS) | (100 * out["n_repeat_words"] > MOST_REPEATED * words)
    out["kept"] = ~out["base_failed"] & (lost <= MOST_LOST * out["word_chars"])
    return out, line_start[lines], bad


def clean(data: np.ndarray, offsets: np.ndarray, line_start: np.ndarray, bad: np.ndarray) -> list[str]:
    """The texts without their bad lines."""
    raw, texts = data.tobytes(), []
    for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
        p, q = np.searchsorted(line_start, [a, b])
        text = raw[a:b]
        if bad[p:q].any():
            gone, kept, at = set(line_start[p:q][bad[p:q]].tolist()), [], a
            for piece in text.split(b"\n"):
                if at not in gone:
                    kept.append(piece)
                at += len(piece) + 1
            text = b"\n".join(kept)
        texts.append(text.decode())
    return texts


def line_first(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts, ``base_failed``, ``kept`` and ``clean_text`` of each whole text."""
    ship(df)

    @F.arrow_udf("struct<n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, n_repeat_words: long, "
                 "n_bad_lines: long, base_failed: boolean, kept: boolean, clean_text: string>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in texts:
            data, offsets = utf8(arr)
            found, cleaned = [], []
            for i, j in blocks(offsets):
                part, offs = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                counts, line_start, bad = judge(part, offs)
                found.append(counts)
                cleaned += clean(part, offs, line_start, bad)
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate([c[f] for c in found]) if found else np.zeros(0, bool if f in ("base_failed", "kept") else np.int64))
                 for f in FIELDS[:-1]] + [pa.array(cleaned, pa.string())], FIELDS)

    return add_fields(df, run(col(text)), FIELDS)


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    return line_first(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "clean_text")
