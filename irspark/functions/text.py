"""Tokenisers and text transforms as Spark Column expressions.

A *tokenizer* here is any callable ``Column -> Column[array<string>]``.  Everything is a
built-in expression, so it runs inside the JVM and Catalyst can see it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

Tokenizer = Callable[[Column], Column]

# Fixed values (must equal Python's ``string.punctuation``): the 32 ASCII punctuation marks.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def tok_whitespace(c) -> Column:
    """``str.split()``: runs of whitespace separate tokens, no empty tokens, case kept."""
    return F.filter(F.split(_text(c), r"\s+"), lambda x: x != F.lit(""))


def tok_alnum(c) -> Column:
    """Lower-case, then every maximal ``[a-z0-9]+`` run is a token (accents split words)."""
    # same tokens as regexp_extract_all('[a-z0-9]+'), about twice as fast in the JVM
    spaced = F.regexp_replace(F.lower(_text(c)), "[^a-z0-9]+", " ")
    return F.filter(F.split(spaced, " "), lambda x: x != F.lit(""))


_ALNUM, _WORD = re.compile(r"[a-z0-9]+"), re.compile(r"[^ \t\n\x0b\f\r]+")


def _count_alnum(text: str) -> Counter:
    return Counter(_ALNUM.findall(text.lower()))


def _count_whitespace(text: str) -> Counter:
    return Counter(_WORD.findall(text))


# Tokenizers may bring a function that gives a text's tokens with their counts in a Python worker: the same tokens as
# the Column's.  Where an index is built it saves the arrays of single tokens, which the JVM would sort row by row.
tok_alnum._irspark_counts = _count_alnum
tok_whitespace._irspark_counts = _count_whitespace


def of_terms(tokenizer: Tokenizer, form: Callable, rule: Callable[[str], str]) -> Tokenizer:
    """Each token of ``tokenizer`` replaced by its ``form``, a Column rule; ``rule`` is the same on Python strings."""
    def tok(c) -> Column:
        return F.transform(tokenizer(c), form)

    counts = getattr(tokenizer, "_irspark_counts", None)
    if counts is not None:
        tok._irspark_counts, tok._irspark_base = _MappedCounts(counts, rule), (tokenizer, rule)
        tok._irspark_key = f"{form.__module__}.{form.__qualname__}({tokenizer.__module__}.{tokenizer.__qualname__})"
    return tok


class _MappedCounts:
    """Counts of the forms of a text's tokens; the forms of many different tokens are remembered."""

    def __init__(self, counts, rule):
        self.counts, self.rule, self.forms = counts, rule, {}

    def __reduce__(self):
        return _MappedCounts, (self.counts, self.rule)

    def __call__(self, text: str) -> Counter:
        if len(self.forms) > MOST_FORMS:
            self.forms.clear()
        out, forms = Counter(), self.forms
        for w, n in self.counts(text).items():
            f = forms.get(w)
            if f is None:
                f = forms[w] = self.rule(w)
            out[f] += n
        return out


MOST_FORMS = 1 << 17


def remove_punct(c) -> Column:
    """Delete the 32 ASCII punctuation characters (no space is inserted)."""
    return F.translate(_text(c), PUNCTUATION, "")


def _word_array(words: Iterable[str]) -> Column:
    words = sorted(set(words))
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def remove_stopwords(tokens, words: Iterable[str] | Column) -> Column:
    """Drop tokens equal (case-sensitive) to a stop word.  ``words`` is a small driver list, or a column
    with the row's own list (null: none); for a table of words see ``remove_stopword_table``."""
    arr = F.coalesce(words, F.array().cast("array<string>")) if isinstance(words, Column) else _word_array(words)
    return F.filter(_col(tokens), lambda x: ~F.coalesce(F.array_contains(arr, x), F.lit(False)))


INLINE_WORDS = 1024          # stop words of a language that each row carries along; more are looked up


def remove_stopword_table(df, words, tokens_col: str = "tokens", id_col: str = "doc_id", word_col: str = "word",
                          lang_col: str | None = None):
    """``df`` without the tokens that a table of stop words holds, in order; with ``lang_col`` (a column of
    both) each row loses the words of its own language only.

    Lists of up to INLINE_WORDS words a language travel with the rows.  Of larger tables a row needs only
    the words that it has: its distinct tokens are looked up, and the tokens are filtered by what was
    found.  Null words, and rows or words of a null language, match nothing.  ``id_col`` names a row and must be distinct.
    """
    from ..contracts import bounded_broadcast, fits_broadcast

    keys = [lang_col] if lang_col else []
    words = words.select(*keys, F.col(word_col).alias("_w")).where(F.col("_w").isNotNull()).distinct()
    sizes = words.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if fits_broadcast(sizes) and (sizes.agg(F.max("n")).first()[0] or 0) <= INLINE_WORDS:
        lists = words.groupBy(*keys).agg(F.collect_set("_w").alias("_s"))
        found = df.join(F.broadcast(lists), keys, "left") if keys else df.crossJoin(F.broadcast(lists))
    else:
        seen = df.select(id_col, *keys, F.explode(F.array_distinct(tokens_col)).alias("_w"))
        mine = seen.join(bounded_broadcast(words), [*keys, "_w"], "left_semi").groupBy(id_col).agg(F.collect_set("_w").alias("_s"))
        found = df.join(mine, id_col, "left")
    return found.withColumn(tokens_col, remove_stopwords(tokens_col, F.col("_s"))).select(*df.columns)


def tok_chain(*, punct: bool = True, stopwords: Iterable[str] | None = None,
              mapping: dict[str, str] | None = None) -> Tokenizer:
    """Compose: remove punctuation -> whitespace split -> drop stop words -> map terms."""
    sw = list(stopwords or [])
    mp = dict(mapping or {})

    def tok(c) -> Column:
        t = remove_punct(c) if punct else _text(c)
        arr = tok_whitespace(t)
        if sw:
            arr = remove_stopwords(arr, sw)
        if mp:
            m = F.create_map(*[x for kv in sorted(mp.items()) for x in (F.lit(kv[0]), F.lit(kv[1]))])
            arr = F.transform(arr, lambda x: F.coalesce(F.try_element_at(m, x), x))
        return arr

    tok._irspark_key = f"tok_chain(punct={punct},stopwords={sorted(set(sw))},mapping={sorted(mp.items())})"
    return tok


def tok_simple(stopwords: Iterable[str]) -> Tokenizer:
    """Punctuation removal, stop-word removal, whitespace split."""
    return tok_chain(punct=True, stopwords=stopwords)


def suffix_stem(c) -> Column:
    """A rule stemmer used as a stand-in stem table: strip one of ing/ed/es/s at the end."""
    return F.regexp_replace(_col(c), "(ing|ed|es|s)$", "")


_STEM_END = re.compile(r"(ing|ed|es|s)$")


def stem_rule(word: str) -> str:
    """``suffix_stem`` of a token."""
    return _STEM_END.sub("", word)


def bigrams(tokens) -> Column:
    """Adjacent token pairs in order, each as ``'left right'``; empty for < 2 tokens."""
    a = _col(tokens)
    n = F.size(a)
    m = F.greatest(n - 1, F.lit(0))
    # the arrays are arguments of zip_with, not captured by the lambda: O(n) per row
    pairs = F.zip_with(F.slice(a, 1, m), F.slice(a, 2, m), lambda x, y: F.concat(x, F.lit(" "), y))
    return F.when(n >= 2, pairs).otherwise(F.array().cast("array<string>"))


def run_ends(sorted_tokens) -> Column:
    """For a sorted token array: ``array<struct<term, e>>`` with the index of the last
    element of every run of equal tokens.  Lambdas touch only their own variables."""
    s = _col(sorted_tokens)
    nxt = F.concat(F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), F.array(F.lit(None).cast("string")))
    # an empty input must give no run (arrays_zip would pad it to one NULL pair)
    s = F.when(F.size(s) > 0, s).otherwise(F.lit(None).cast("array<string>"))
    return F.filter(
        F.transform(F.arrays_zip(s.alias("a"), nxt.alias("b")),
                    lambda p, i: F.struct(p["a"].alias("term"), i.alias("e"),
                                          (p["b"].isNull() | (p["a"] != p["b"])).alias("last"))),
        lambda x: x["last"])


def run_lengths(ends) -> Column:
    """``run_ends`` output -> ``array<struct<term, tf>>`` (differences of run-end indexes)."""
    e = _col(ends)
    prev = F.concat(F.array(F.lit(-1)), F.slice(e["e"], 1, F.greatest(F.size(e) - 1, F.lit(0))))
    return F.zip_with(e, prev, lambda x, pe: F.struct(x["term"].alias("term"), (x["e"] - pe).cast("bigint").alias("tf")))


def first_positions(tokens) -> Column:
    """``array<struct<term, pos>>``: every distinct token with the 0-based position of its
    first occurrence, computed in-row (sort (term, pos) pairs, keep run starts)."""
    t = _col(tokens)
    n = F.size(t)
    pairs = F.sort_array(F.arrays_zip(t.alias("term"), F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))).alias("pos")))
    prev = F.concat(F.array(F.lit(None).cast("string")), F.slice(pairs["term"], 1, F.greatest(n - 1, F.lit(0))))
    firsts = F.filter(F.zip_with(pairs, prev, lambda p, q: F.struct(p["term"].alias("term"), p["pos"].alias("pos"),
                                                                    (q.isNull() | (p["term"] != q)).alias("f"))),
                      lambda x: x["f"])
    out = F.transform(firsts, lambda x: F.struct(x["term"].alias("term"), x["pos"].alias("pos")))
    return F.when(n > 0, out).otherwise(F.array().cast("array<struct<term:string,pos:int>>"))


def term_counts(tokens) -> Column:
    """Per-row term frequencies as one expression (for small inputs; the DataFrame version
    :func:`irspark.operators.index.postings_from_tokens` stages it so nothing is recomputed)."""
    return run_lengths(run_ends(F.sort_array(_col(tokens))))


def normalize_answer(c) -> Column:
    """SQuAD answer normalisation: lower, drop punctuation, drop a/an/the, squeeze spaces."""
    t = F.translate(F.lower(_text(c)), PUNCTUATION, "")
    # word boundaries in the Unicode sense (letters / digits / underscore), as Python's re
    t = F.regexp_replace(t, r"(?<![\p{L}\p{N}_])(a|an|the)(?![\p{L}\p{N}_])", " ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


TOKENIZERS: dict[str, Tokenizer] = {"whitespace": tok_whitespace, "alnum": tok_alnum}


def normalize_terms(tokens_df, mapping, id_col: str = "doc_id", tokens_col: str = "tokens",
                    term_col: str = "term", mapped_col: str = "mapped"):
    """Replace every token by its mapped form (stem / lemma table), in order; unknown tokens stay.

    A mapping within the broadcast bounds goes to every Python worker, where the distinct tokens of a batch
    are mapped once; no row is moved.  Of a larger one the forms of the most frequent tokens, at most HOT_FORMS,
    go that way, and only the other distinct tokens of each row are joined with it.  Null tokens arrays
    become empty; of a term's several forms the smallest counts.  Where the order of tokens does not matter,
    ``Index.mapped`` maps the vocabulary of an index instead.
    """
    from ..contracts import fits_broadcast

    m = (mapping.select(F.col(term_col).cast("string").alias("_t"), F.col(mapped_col).cast("string").alias("_m"))
         .where("_t IS NOT NULL AND _m IS NOT NULL").groupBy("_t").agg(F.min("_m").alias("_m"))
         .where("_t <> _m").checkpoint(eager=True))                  # terms that stay need no entry
    sc = tokens_df.sparkSession.sparkContext
    tokens = F.coalesce(F.col(tokens_col), F.array().cast("array<string>"))
    if fits_broadcast(m):
        shared = sc.broadcast({r["_t"]: r["_m"] for r in m.collect()})   # of that bound
        return tokens_df.withColumn(tokens_col, _mapped_tokens(shared)(tokens))
    seen = tokens_df.select(id_col, F.explode(F.array_distinct(tokens_col)).alias("_t"))
    counts = seen.groupBy("_t").agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    least = least_count(counts)
    hot = counts.where(F.col("_n") >= least).select("_t")             # at most HOT_FORMS tokens, mapped or not
    shared = sc.broadcast({r["_t"]: r["_m"] for r in m.join(F.broadcast(hot), "_t", "left_semi").collect()})
    rest = seen.join(F.broadcast(hot), "_t", "left_anti").join(m, "_t")
    mine = (rest.groupBy(F.col(id_col).alias("_mapped_id")).agg(F.collect_list(F.struct("_t", "_m")).alias("_mapped_forms")).hint("shuffle_hash"))
    out = tokens_df.join(mine, F.col(id_col).eqNullSafe(F.col("_mapped_id")), "left")
    return out.withColumn(tokens_col, _mapped_by_row(shared)(tokens, F.col("_mapped_forms._t"), F.col("_mapped_forms._m"))).select(*tokens_df.columns)


HOT_FORMS = 1 << 19   # most frequent tokens whose forms go to every Python worker when the mapping is large


def least_count(counts) -> int:
    """The least count so that at most HOT_FORMS tokens, of at most 64 bytes on average, have it."""
    left, bytes_left, least = HOT_FORMS, HOT_FORMS * 64, 1 << 62
    sizes = counts.groupBy("_n").agg(F.count(F.lit(1)).alias("c"), F.sum(F.octet_length("_t")).alias("b"))
    for r in sorted(sizes.collect(), key=lambda r: -r["_n"]):         # different counts: about the root of all tokens
        left, bytes_left = left - r["c"], bytes_left - r["b"]
        if left < 0 or bytes_left < 0:
            break
        least = r["_n"]
    return least


def _mapped_tokens(shared):
    @F.arrow_udf("array<string>")
    def run(tokens):
        import pyarrow as pa

        words = tokens.flatten().dictionary_encode()
        forms = pa.array([shared.value.get(w, w) for w in words.dictionary.to_pylist()], pa.string())
        return pa.ListArray.from_arrays(_offsets(tokens), forms.take(words.indices))
    return run


def _mapped_by_row(shared):
    @F.arrow_udf("array<string>")
    def run(tokens, terms, forms):
        import pyarrow as pa

        known = dict(zip(terms.flatten().to_pylist(), forms.flatten().to_pylist()))   # a term has one form everywhere
        words = tokens.flatten().dictionary_encode()
        names = [known[w] if w in known else shared.value.get(w, w) for w in words.dictionary.to_pylist()]
        return pa.ListArray.from_arrays(_offsets(tokens), pa.array(names, pa.string()).take(words.indices))
    return run


def _offsets(lists):
    """Offsets of a list array from 0, as its flattened values have them."""
    import pyarrow.compute as pc

    return pc.subtract(lists.offsets, lists.offsets[0])


def resolve_tokenizer(tokenizer) -> Tokenizer:
    if tokenizer is None:
        return tok_alnum
    if isinstance(tokenizer, str):
        return TOKENIZERS[tokenizer]
    return tokenizer
