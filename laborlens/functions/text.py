"""Text and array functions: dictionary tagging, list parsing, set algebra."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K

# Characters that count as part of a word on both sides of a term.
WORD_CLASS = r"\p{L}\p{N}_"


def escape_term(term: str) -> str:
    """Backslash every character that is not a letter, digit or space; the
    result means the same literal in Java regex and in RE2."""
    return "".join(ch if (ch.isalnum() or ch == " ") else "\\" + ch for ch in term)


def term_pattern(term: str, boundary: str = "token") -> str:
    """Pattern for one lower-cased term.

    ``token``: no word character directly before or after the term, so
    ``c++ dev`` and ``c# dev`` are found.  ``word``: Unicode ``\\b`` on both
    ends, which is what a ``\\bterm\\b`` search does (it cannot match ``c++``
    followed by a space)."""
    body = escape_term(term.lower())
    if boundary == "word":
        return rf"(?U)\b{body}\b"
    return rf"(?<![{WORD_CLASS}]){body}(?![{WORD_CLASS}])"


def is_single_word(term: str) -> bool:
    """Only word characters (letters, digits, '_')."""
    return all(ch.isalnum() or ch == "_" for ch in term)


def word_hits(text, vocab: Sequence[str] = K.TECH_TERMS, lowered: bool = False) -> Column:
    """Distinct lower-cased single-word vocabulary terms that occur as a
    whole word of ``text``: one split into maximal word runs, then a hash
    intersection with the term list."""
    t = F.col(text) if isinstance(text, str) else text
    t = t if lowered else F.lower(t)
    singles = sorted({v.lower() for v in vocab if is_single_word(v.lower())})
    words = F.split(t, f"[^{WORD_CLASS}]+")
    return F.array_intersect(words, str_array(singles))


def tag_terms(text, vocab: Sequence[str] = K.TECH_TERMS, boundary: str = "token", hits=None,
              lowered: bool = False) -> Column:
    """Terms of ``vocab`` found in ``text`` (independent matches, so
    ``Spring`` and ``Spring Boot`` both hit), in vocabulary order; null text ->
    empty array.

    ``token`` boundary: a term of word characters only matches exactly when
    it equals one of the text's maximal word runs, so those terms are looked
    up in ``hits`` (see :func:`word_hits`; one split per text).  Terms with
    other characters (``c++``, ``vue.js``, ``spring boot``) use the regex,
    guarded by a plain substring test so it runs only where the term occurs."""
    t = F.col(text) if isinstance(text, str) else text
    t = t if lowered else F.lower(t)
    if boundary == "token" and hits is None:
        hits = word_hits(t, vocab, lowered=True)
    found = []
    for term in vocab:
        low = term.lower()
        if boundary == "token" and is_single_word(low):
            hit = F.when(F.array_contains(hits, F.lit(low)), F.lit(term))
        else:
            hit = F.when(t.contains(low) & t.rlike(term_pattern(term, boundary)), F.lit(term))
        found.append(hit)
    arr = F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast("array<string>")
    return F.when(t.isNull(), F.array().cast("array<string>")).otherwise(arr)


def parse_list_text(col) -> Column:
    """A list-ish string -> array.  With '[' take the single-quoted parts,
    else split on commas, trim, drop empties.  Null -> empty array."""
    c = F.col(col) if isinstance(col, str) else col
    quoted = F.regexp_extract_all(c, F.lit(r"'([^']*)'"), 1)
    plain = F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")
    return (F.when(c.isNull(), F.array().cast("array<string>"))
            .when(c.contains("["), quoted).otherwise(plain))


def merge_arrays(a, b) -> Column:
    """Distinct union of two arrays, sorted for a stable order."""
    return F.sort_array(F.array_union(F.coalesce(a, F.array().cast("array<string>")),
                                      F.coalesce(b, F.array().cast("array<string>"))))


def parse_skill_input(col) -> Column:
    """C20: user skill text: lower, trim, split on ',', trim, ' ' -> '_',
    drop empty items."""
    c = F.col(col) if isinstance(col, str) else col
    items = F.transform(F.split(F.lower(F.trim(c)), ","), lambda x: F.replace(F.trim(x), F.lit(" "), F.lit("_")))
    return F.filter(items, lambda x: x != "")


def in_vocab(arr, vocab_arr) -> Column:
    """C21 (recognised): items of ``arr`` that are in ``vocab_arr`` (keeps
    duplicates and order)."""
    return F.filter(arr, lambda x: F.array_contains(vocab_arr, x))


def not_in_vocab(arr, vocab_arr) -> Column:
    """C21 (unrecognised)."""
    return F.filter(arr, lambda x: ~F.array_contains(vocab_arr, x))


def str_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")
