"""Text column expressions. All built-in Spark functions: they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# Accent folding of the keyword normalizer (source chars, then replacements).
FOLD_FROM = "áéíóúÁÉÍÓÚüÜñÑ"
FOLD_TO = "aeiouAEIOUuUnN"
# Search terms that mean "no term" (compared lower-cased, after trim).
NOT_SET_TERMS = ["(not set)", "not set"]
# English stopwords dropped by the product-text tokenizer.
STOPWORDS_EN = ("a an and are as at be been by for from has have he her his i in is it its "
                "of on or that the to was were with you your").split()
# Domain stopwords dropped by the product-text tokenizer.
DOMAIN_STOPWORDS = ("details made fabric weight program recycled recyclable common threads "
                    "recycling polyester cotton organic").split()
# Token length bounds of the tokenizer (inclusive).
TOKEN_MIN_LEN, TOKEN_MAX_LEN = 3, 20
# ---------------------------------------------------------------------------


# Whitespace as text tools strip it: beyond the blank, control characters that separate and
# the blanks of Unicode.
WHITESPACE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680,
                               *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Without whitespace of any kind at both ends (``F.trim`` alone takes blanks only)."""
    return F.trim(_c(c), F.lit(WHITESPACE))


def norm_txt(c) -> Column:
    """NULL -> '', fold Spanish accents, lower-case. Does not trim."""
    return F.lower(F.translate(F.coalesce(_c(c), F.lit("")), FOLD_FROM, FOLD_TO))


def blank_to_null(c) -> Column:
    return F.nullif(_c(c), F.lit(""))


def canonical_choice(synonym, canonical) -> Column:
    """A non-blank synonym overrides the canonical keyword."""
    return F.coalesce(blank_to_null(synonym), _c(canonical))


def mapping_type(is_typo, synonym) -> Column:
    return (F.when(_c(is_typo), F.lit("TYPO"))
            .when(_c(synonym).isNotNull() & (_c(synonym) != ""), F.lit("SYNONYM"))
            .otherwise(F.lit("CANON")))


def clean_search_term(c) -> Column:
    """Strip; '' and (not set) variants become NULL (callers drop NULL terms)."""
    t = strip(c)
    return F.when((t != "") & ~F.lower(t).isin(*NOT_SET_TERMS), t)


def keyword_header_clean(c) -> Column:
    """Strip quotes/BOM/whitespace, cut at the first ':' ("celular: (Peru)" -> "celular")."""
    s = F.regexp_replace(strip(c), '^["﻿]+|"+$', "")
    return strip(F.substring_index(s, ":", 1))


def blank_default(c, default: str, trim: bool = True) -> Column:
    v = F.trim(_c(c)) if trim else _c(c)
    return F.coalesce(F.nullif(v, F.lit("")), F.lit(default))


def label_with_count(term, n) -> Column:
    return F.concat(_c(term), F.lit(" ("), _c(n).cast("string"), F.lit(")"))


def token_text(c) -> Column:
    """Product text reduced to lower-case ASCII words separated by spaces (tags dropped)."""
    t = F.regexp_replace(_c(c), "<[^>]+>", " ")
    return F.lower(F.regexp_replace(t, "[^a-zA-Z0-9 ]+", " "))


def keep_token(w) -> Column:
    """Token filter: 3..20 chars, not a stopword, not all digits (plain predicates, so
    they compile with the rest of the stage)."""
    w = _c(w)
    return ((F.length(w) >= TOKEN_MIN_LEN) & (F.length(w) <= TOKEN_MAX_LEN)
            & ~w.isin(*(STOPWORDS_EN + DOMAIN_STOPWORDS)) & ~w.rlike("^[0-9]+$"))


def tokenize(c) -> Column:
    """Token array of a text (same rules as ``token_text`` + ``keep_token``). For large
    inputs prefer exploding ``split(token_text(c), ' ')`` and filtering with
    ``keep_token``: lambdas of higher-order functions are interpreted per element."""
    return F.filter(F.split(token_text(c), " "), keep_token)


def first_word(c) -> Column:
    return F.substring_index(_c(c), " ", 1)


def last_word(c) -> Column:
    return F.substring_index(_c(c), " ", -1)
