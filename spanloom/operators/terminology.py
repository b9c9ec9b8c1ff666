"""Code dictionaries: alias tables, exact links, lexical and vector retrieval.

A dictionary has one row per code: code, label, aliases. Lookups are equi-joins on normalised names;
a dictionary side is broadcast only if counting shows that it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.text import char_ngrams, clean_mention, normalize_surface, normalize_term, strip_diacritics, tokens
from spanloom.operators.spans import first_per

# Term types of a drug vocabulary, and the columns of its rows.
CONCEPT_TTY = ("SCD", "SBD", "BN", "IN", "PIN", "MIN")
NAME_TTY = (*CONCEPT_TTY, "SY", "PSN", "TMSY")
LABEL_TTY = ("IN", "PIN", "BN")
RRF_COLUMNS = {"code": 0, "source": 11, "tty": 12, "name": 14, "suppress": 16}
TTY_RANK = ("SBD", "SCD", "GPCK", "BPCK", "IN", "PIN", "MIN")
TOP_K, LEXICAL_POOL = 20, 160
BLOCK_ENTRIES = 5_000


def names_of(terms: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(code, name, *extra) for the label and every alias; blank and NULL names are left out."""
    none = F.array().cast("array<string>")
    name = F.explode(F.concat(F.array("label"), F.coalesce("aliases", none)))
    return terms.select("code", *extra, name.alias("name")).where("name is not null and trim(name) != ''")


def alias_index(terms: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(kind, key, *extra, codes): every normalised name, with accents (``exact``) and without
    (``plain``), and the sorted codes that bear it."""
    n = names_of(terms, extra).withColumn("key", normalize_surface(F.col("name"))).where("key != ''")
    both = n.select("code", *extra, F.explode(F.array(F.struct(F.lit("exact").alias("kind"), "key"), F.struct(F.lit("plain").alias("kind"), strip_diacritics(F.col("key")).alias("key")))).alias("k"))
    return both.groupBy("k.kind", "k.key", *extra).agg(F.array_sort(F.collect_set("code")).alias("codes"))


def exact_link(mentions: DataFrame, terms: DataFrame, text: str = "text", drug: Column | None = None, extra: tuple[str, ...] = (), max_codes: int = 1) -> DataFrame:
    """``mentions`` with ``found`` (all codes of the name) and ``codes`` (those linked: the code if it
    is the only one, else none).

    The accented name decides if it is known at all; only otherwise the accentless one is looked up.
    A three-sign code whose ``.9`` leaf exists is taken as the leaf, after uniqueness is judged.
    Blank and NULL mentions link to nothing. Distinct names are looked up once and joined back.
    """
    key = normalize_surface(clean_mention(F.col(text), drug if drug is not None else F.lit(False)))
    m = mentions.withColumn("_key", key)
    wanted = m.select("_key", *extra).where("_key is not null and _key != ''").distinct()
    index = alias_index(terms, extra)
    exact = index.where("kind = 'exact'").select(F.col("key").alias("_key"), *extra, F.col("codes").alias("_exact"))
    plain = index.where("kind = 'plain'").select(F.col("key").alias("_bare"), *extra, F.col("codes").alias("_plain"))
    leaf = terms.where(F.col("code").endswith(".9")).select(F.expr("substring(code, 1, length(code) - 2)").alias("_one"), F.col("code").alias("_leaf")).distinct()
    found = wanted.join(exact, ["_key", *extra], "left").withColumn("_bare", strip_diacritics(F.col("_key"))).join(plain, ["_bare", *extra], "left")
    none = F.array().cast("array<string>")
    found = found.withColumn("found", F.coalesce("_exact", "_plain", none)).withColumn("_one", F.when((F.size("found") == 1) & F.get("found", F.lit(0)).rlike(r"^[A-Z]\d\d$"), F.get("found", F.lit(0))))
    found = found.join(leaf, "_one", "left").withColumn("codes", F.when(F.size("found") == 1, F.array(F.coalesce("_leaf", F.get("found", F.lit(0))))).otherwise(none))
    found = found.select("_key", *extra, "found", F.slice("codes", 1, max_codes).alias("codes"))
    return m.join(found, ["_key", *extra], "left").drop("_key").withColumns({"found": F.coalesce("found", none), "codes": F.coalesce("codes", none)})


def load_terms(rows: DataFrame) -> DataFrame:
    """First row wins per code (by ``ord``); rows with a blank code or label are left out."""
    ok = rows.where("trim(code) != '' and trim(label) != ''")
    return first_per(ok, ["code"], ["ord"])


def fold_aliases(names: DataFrame) -> DataFrame:
    """(code, label, aliases) from (code, ord, name): the label is the first name, the aliases the
    later distinct ones in order. Codes of less than three signs without the dot are left out."""
    ok = names.where((F.length(F.replace("code", F.lit("."), F.lit(""))) >= 3) & (F.trim("name") != ""))
    first = ok.groupBy("code", "name").agg(F.min("ord").alias("ord"))
    out = first.groupBy("code").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))), lambda x: x["name"]).alias("n"))
    return out.select("code", F.get("n", F.lit(0)).alias("label"), F.slice("n", F.lit(2), F.size("n")).alias("aliases"))


def rrf_rows(lines: DataFrame, source: str = "RXNORM") -> DataFrame:
    """(code, tty, name, ord) of pipe-delimited vocabulary lines (value, ord): at least 17 fields, the
    source's own rows, not suppressed, a name."""
    f = F.split("value", r"\|", -1)
    c = {k: F.get(f, F.lit(i)) for k, i in RRF_COLUMNS.items()}
    ok = (F.size(f) >= 17) & (c["source"] == source) & c["suppress"].isin("N", "") & (F.trim(c["name"]) != "")
    return lines.where(ok).select(F.trim(c["code"]).alias("code"), c["tty"].alias("tty"), F.trim(c["name"]).alias("name"), "ord")


def fold_drug_names(rows: DataFrame) -> DataFrame:
    """(code, label, aliases) from (code, tty, name, ord). Only codes that some row qualifies as a
    concept; the label moves to a shorter ingredient or brand name (the old one becomes an alias),
    other new names are appended."""
    fit = rows.join(rows.where(F.col("tty").isin(*CONCEPT_TTY)).select("code").distinct(), "code", "left_semi").where(F.col("tty").isin(*NAME_TTY))
    row = F.struct("ord", "tty", "name")
    grouped = fit.groupBy("code").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    none = F.array().cast("array<string>")

    def step(acc: Column, x: Column) -> Column:
        shorter = x["tty"].isin(*LABEL_TTY) & (F.length(x["name"]) < F.length(acc["label"]))
        new = (x["name"] != acc["label"]) & ~F.array_contains(acc["aliases"], x["name"])
        return (
            F.when(acc["label"].isNull(), F.struct(x["name"].alias("label"), none.alias("aliases")))
            .when(shorter, F.struct(x["name"].alias("label"), F.array_append(acc["aliases"], acc["label"]).alias("aliases")))
            .when(new, F.struct(acc["label"].alias("label"), F.array_append(acc["aliases"], x["name"]).alias("aliases")))
            .otherwise(acc)
        )

    start = F.struct(F.lit(None).cast("string").alias("label"), none.alias("aliases"))
    return grouped.select("code", F.aggregate("rows", start, step).alias("t")).select("code", "t.label", "t.aliases")


def rank_labels(rows: DataFrame, most: int = 24) -> DataFrame:
    """(code, label, aliases) from (code, preferred, tty, name): the label is least by (preferred
    first, term type, length, lower case), the aliases are the rest by length, at most ``most``."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, TTY_RANK)), F.col("tty")), F.lit(0)), F.lit(100))
    key = F.struct(F.when(F.col("preferred"), 0).otherwise(1).alias("a"), rank.alias("b"), F.length("name").alias("c"), F.lower("name").alias("d"), F.col("name").alias("e"))
    best = rows.groupBy("code", "name").agg(F.min(key).alias("k")).groupBy("code").agg(
        F.min("k").alias("k"), F.array_sort(F.collect_list(F.struct(F.length("name").alias("n"), F.lower("name").alias("l"), F.col("name").alias("name")))).alias("all")
    )
    names = F.transform(F.col("all"), lambda x: x["name"])
    return best.select("code", F.col("k.e").alias("label"), F.slice(F.filter(names, lambda x: x != F.col("k.e")), 1, most).alias("aliases"))


def postings(terms: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(kind, term, *extra, code): every name, word of two signs and more, and 3-gram of an entry."""
    n = names_of(terms, extra).withColumn("q", normalize_term(F.col("name"))).where("q != ''")
    parts = F.concat(
        F.array(F.struct(F.lit("name").alias("kind"), F.col("q").alias("term"))),
        F.transform(F.filter(tokens(F.col("q")), lambda w: F.length(w) >= 2), lambda w: F.struct(F.lit("word").alias("kind"), w.alias("term"))),
        F.transform(char_ngrams(F.col("q")), lambda g: F.struct(F.lit("gram").alias("kind"), g.alias("term"))),
    )
    return n.select("code", *extra, F.explode(parts).alias("p")).select("p.kind", "p.term", *extra, "code").distinct()


def entries(terms: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(code, *extra, names, words, grams): the sets of an entry over all its names."""
    n = names_of(terms, extra).withColumn("q", normalize_term(F.col("name"))).where("q != ''")
    return n.groupBy("code", *extra).agg(
        F.array_sort(F.collect_set("q")).alias("names"),
        F.array_distinct(F.flatten(F.collect_set(F.filter(tokens(F.col("q")), lambda w: F.length(w) >= 2)))).alias("words"),
        F.array_distinct(F.flatten(F.collect_set(char_ngrams(F.col("q"))))).alias("grams"),
    )


def retrieve(queries: DataFrame, terms: DataFrame, text: str = "text", extra: tuple[str, ...] = (), top_k: int = TOP_K, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """The ``top_k`` entries of each distinct query: (query, *extra, code, score, exact, rank).

    Candidates share a name, a word or a 3-gram with the query. Their score is 1 for an equal name, 0.18 for
    a name that contains the query or is part of it, 0.55 times the Jaccard share of words and 0.27 times that
    of 3-grams, 1 at most; they are ranked by falling score, exact before other, code. The entries go to the
    workers in blocks of about ``block_entries``; of each block the best are kept, and those are merged, so no
    candidate but the best moves. NULL, empty and blank queries retrieve nothing.
    """
    q = queries.select(F.col(text).alias("query"), *extra).where("query is not null").distinct().withColumn("q", normalize_term(F.col("query"))).where("q != ''")
    key = F.to_json(F.struct("q", *extra), {"ignoreNullFields": "false"})
    asked = q.select("q", *extra).distinct().withColumn("_query", key)
    out = _in_blocks(asked, entries(terms, extra), extra, top_k, 0, block_entries)
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), (~F.col("exact")).alias("e"), "code"))), 1, top_k)
    hits = q.withColumn("_query", key).join(out.groupBy("_query").agg(best.alias("best")), "_query").select("query", *extra, F.posexplode("best").alias("rank", "b"))
    return hits.select("query", *extra, "b.code", (-F.col("b.s")).alias("score"), (~F.col("b.e")).alias("exact"), (F.col("rank") + 1).alias("rank"))


def _in_blocks(queries: DataFrame, every: DataFrame, extra: tuple[str, ...], top_k: int, pool: int, block_entries: int, vectors: DataFrame | None = None) -> DataFrame:
    """``queries`` scored against each block of the entries ``every``; with ``vectors`` (code, extra, embedding) by both kinds of evidence."""
    import math

    import numpy as np

    blocks = max(1, math.ceil(every.count() / block_entries))
    width = (vectors.agg(F.max(F.size("embedding"))).first()[0] or 0) if vectors is not None else 0
    out = None
    for b in range(blocks):
        mine = F.pmod(F.xxhash64("code"), F.lit(blocks)) == b
        near = None
        if vectors is not None:
            near = {(tuple(r[x] for x in extra), r["code"]): np.asarray(r["embedding"], dtype=np.float64) for r in vectors.where(mine & F.col("embedding").isNotNull()).collect()}
        # without vectors the best of a block are all that can count
        one = _score_in_workers(queries, every.where(mine).collect(), extra, top_k, pool, near, width, vectors is None or blocks == 1)
        out = one if out is None else out.unionByName(one)
    return out


def combine(lexical: Column, cosine: Column) -> Column:
    """Lexical and vector evidence in one score; NULL where the cosine isn't finite."""
    return F.when(~F.isnan(cosine), 0.52 * lexical + 0.48 * (cosine + 1) / 2)


def _block_scorer(rows: list, vectors: dict):  # noqa: ANN202
    """A function (q, dots, top_k, pool, whole) -> (places, scores, exact, dots, lexical, in_pool) over one block
    of entries (code, names, words, grams) in the order of their codes.

    If the block is the ``whole`` dictionary, the best ``top_k`` are given; else all of the pool and the
    ``top_k`` best lexical ones.
    """
    from bisect import bisect_right

    import numpy as np

    n = len(rows)
    exact: dict[str, list[int]] = {}
    words: dict[str, list[int]] = {}
    grams: dict[str, list[int]] = {}
    for i, r in enumerate(rows):
        for index, terms in ((exact, r["names"]), (words, r["words"]), (grams, r["grams"])):
            for t in terms:
                index.setdefault(t, []).append(i)
    words, grams = ({t: np.array(v) for t, v in x.items()} for x in (words, grams))
    n_words, n_grams = (np.array([len(r[c]) for r in rows]) for c in ("words", "grams"))
    has = np.array([r["code"] in vectors for r in rows], dtype=bool)
    lengths = sorted({len(m) for m in exact})
    line = "\n".join(exact)
    ends = np.cumsum([len(m) + 1 for m in exact]).tolist()
    owners = list(exact.values())

    def share(index, asked, sizes):  # noqa: ANN001, ANN202
        at = [index[t] for t in asked if t in index]
        common = np.bincount(np.concatenate(at), minlength=n) if at else np.zeros(n, dtype=np.int64)
        return common, common / np.maximum(sizes + len(asked) - common, 1)

    def contained(q):  # noqa: ANN001, ANN202
        part = np.zeros(n)
        for size in lengths:
            for i in range(len(q) - size + 1):
                if (m := q[i : i + size]) in exact:
                    part[exact[m]] = 1.0
        i = line.find(q)
        while i >= 0:
            k = bisect_right(ends, i)
            part[owners[k]] = 1.0
            i = line.find(q, ends[k])
        return part

    def score(q, dots, top_k, pool, whole):  # noqa: ANN001, ANN202
        x = q.replace(" ", "_")  # the parts of functions.text: tokens of two signs and more, char_ngrams
        w, by_word = share(words, {t for t in q.split(" ") if len(t) >= 2}, n_words)
        g, by_gram = share(grams, {x[i : i + 3] for i in range(max(len(x) - 2, 1))}, n_grams)
        name = np.zeros(n)
        name[exact.get(q, [])] = 1.0
        lexical = (w > 0) | (g > 0) | (name > 0)
        total = np.where(lexical, np.minimum(1.0, name + 0.18 * contained(q) + 0.55 * by_word + 0.27 * by_gram), 0.0)
        in_pool = np.zeros(n, dtype=bool)
        if dots is not None:
            total = np.where(has, 0.52 * total + 0.48 * (dots + 1) / 2, total)
            near = np.nonzero(has & np.isfinite(dots))[0]
            if len(near) > pool:
                near = near[dots[near] >= np.partition(dots[near], -pool)[-pool]]
            in_pool[near[np.argsort(-dots[near], kind="stable")[:pool]]] = True
        at = np.nonzero((lexical | in_pool) & np.isfinite(total))[0]
        if whole and len(at) > top_k:
            at = at[total[at] >= np.partition(total[at], -top_k)[-top_k]]
        at = at[np.lexsort((at, -name[at], -total[at]))]
        at = at[:top_k] if whole else at[in_pool[at] | (np.cumsum(lexical[at]) <= top_k)]
        return at, total[at], name[at] > 0, np.full(len(at), np.nan) if dots is None else dots[at], lexical[at], in_pool[at]

    return score


def _score_in_workers(queries: DataFrame, rows: list, extra: tuple[str, ...], top_k: int, pool: int = 0, vectors: dict | None = None, width: int = 0, whole: bool = True) -> DataFrame:
    """``queries`` (q, *extra, _query, ...; with ``embedding`` where ``vectors`` are given) scored against collected
    entries: (_query, code, score, exact, dot, lexical, in_pool), as ``_block_scorer`` keeps them."""
    import numpy as np
    import pandas as pd

    groups: dict[tuple, list] = {}
    for r in sorted(rows, key=lambda r: r["code"]):
        groups.setdefault(tuple(r[e] for e in extra), []).append(r.asDict())
    kind = queries.schema["_query"].dataType.simpleString()

    def run(batches):  # noqa: ANN001, ANN202
        ready = {}
        for key, some in groups.items():
            mine = {c: v for c in (r["code"] for r in some) if len(v := (vectors or {}).get((key, c), ())) == width > 0}
            matrix = np.array([mine.get(r["code"], np.zeros(width)) for r in some], dtype=np.float64) if mine else None
            ready[key] = _block_scorer(some, mine), np.array([r["code"] for r in some], dtype=object), matrix
        for pdf in batches:
            keys = list(zip(*(pdf[e] for e in extra), strict=True)) if extra else [()] * len(pdf)
            given = pdf["embedding"].tolist() if vectors is not None else [None] * len(pdf)
            parts = []
            for q, query, key, e in zip(pdf["q"].tolist(), pdf["_query"].tolist(), keys, given, strict=True):
                if key not in ready:
                    continue
                score, codes, matrix = ready[key]
                # rounded, so that equal vectors tie wherever they stand in the matrix
                dots = np.round(np.einsum("ij,j->i", matrix, np.asarray(e, dtype=np.float64)), 12) if matrix is not None and e is not None and len(e) == matrix.shape[1] else None
                at, *rest = score(q, dots, top_k, pool, whole)
                parts.append(([query] * len(at), codes[at], *rest))
            if parts:
                names = ("code", "score", "exact", "dot", "lexical", "in_pool")
                yield pd.DataFrame({"_query": [x for p in parts for x in p[0]]} | {c: np.concatenate([p[i + 1] for p in parts]) for i, c in enumerate(names)})

    need = ["q", *extra, "_query", *(["embedding"] if vectors is not None else [])]
    return queries.select(*need).mapInPandas(run, f"_query {kind}, code string, score double, exact boolean, dot double, lexical boolean, in_pool boolean")


def hybrid_retrieve(queries: DataFrame, terms: DataFrame, vectors: DataFrame, text: str = "text", extra: tuple[str, ...] = (), keys: tuple[str, ...] = (), top_k: int = TOP_K, pool: int = LEXICAL_POOL, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """The ``top_k`` entries of each distinct query by lexical and vector evidence: (query, *keys, *extra, code,
    score, exact, rank).

    ``queries``: text, ``keys`` (further columns that tell queries apart, such as their context), extra,
    embedding. ``vectors``: code, extra, embedding, of length 1 and one per code. Members are all entries
    that share a name, word or 3-gram with the query, and the ``pool`` entries with the greatest dot
    products (equal ones by code). Every member has both parts, 0.52 and 0.48 of the score; a member that is
    near only has a lexical part of 0. Ranks are by falling score, exact before other, code. Without a vector
    of the query or entry, or with one of another length, the lexical score alone counts. Members whose score
    isn't finite are left out. NULL, empty and blank texts retrieve nothing; of repeated queries one is answered.

    The entries go to the workers in blocks of about ``block_entries``; the bests of the blocks are merged.
    """
    names = [text, *keys, *extra]
    q = queries.select(*names, "embedding").where(F.col(text).isNotNull()).withColumn("q", normalize_term(F.col(text))).where("q != ''")
    q = q.dropDuplicates(names).select("q", *extra, F.struct(F.col(text).alias("query"), *keys, *extra).alias("s"), "embedding").withColumn("_query", F.to_json("s", {"ignoreNullFields": "false"}))
    shape = q.schema["s"].dataType
    out = _in_blocks(q, entries(terms, extra), extra, top_k, pool, block_entries, vectors)
    # the pool of the whole list is the best of the blocks' pools
    by_dot = Window.partitionBy("_query", "in_pool").orderBy(F.col("dot").desc(), "code")
    out = out.withColumn("in_pool", F.col("in_pool") & (F.row_number().over(by_dot) <= pool)).where("lexical or in_pool")
    order = Window.partitionBy("_query").orderBy(F.col("score").desc(), F.col("exact").desc(), "code")
    best = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_k)
    return best.withColumn("s", F.from_json("_query", shape)).select("s.*", "code", "score", "exact", "rank")


def vector_topk(queries: DataFrame, vectors: DataFrame, k: int, block_rows: int = 2_000) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` (id, embedding) by dot product for each query (qid,
    embedding): (qid, id, dot, rank); equal products are ordered by id.

    The queries are the stated set. They go to the workers in blocks of at most ``block_rows``; each
    scan of ``vectors`` keeps the best ``k`` per query and batch, and a window merges those. A query meets the
    rows whose vectors are as long as its own; rows and queries with NULL vectors are left out; products
    that aren't finite too.
    """
    import numpy as np
    import pandas as pd

    n = queries.count()
    blocks = max(1, -(-n // block_rows))
    kinds = queries.schema["qid"].dataType.simpleString(), vectors.schema["id"].dataType.simpleString()
    out = None
    for b in range(blocks):
        some = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == b)
        by_width: dict[int, tuple[list, list]] = {}
        for r in some.where("embedding is not null").collect():
            ids, rows = by_width.setdefault(len(r["embedding"]), ([], []))
            ids.append(r["qid"])
            rows.append(r["embedding"])
        asked = {w: (np.array(ids), np.array(rows, dtype=np.float64)) for w, (ids, rows) in by_width.items() if w}

        def run(batches, asked=asked):  # noqa: ANN001, ANN202
            for pdf in batches:
                lengths = np.array([-1 if e is None else len(e) for e in pdf["embedding"]])
                for width, (ids, matrix) in asked.items():
                    mine = pdf[lengths == width]
                    if not len(mine):
                        continue
                    have = mine["id"].to_numpy()
                    dots = matrix @ np.stack(mine["embedding"].to_numpy()).astype(np.float64).T
                    dots[~np.isfinite(dots)] = -np.inf
                    # everything as good as the k-th is kept, so that ties are decided by id alone
                    least = np.partition(dots, -k, axis=1)[:, -k] if dots.shape[1] > k else np.full(len(ids), -np.inf)
                    q, at = np.nonzero((dots >= least[:, None]) & np.isfinite(dots))
                    yield pd.DataFrame({"qid": ids[q], "id": have[at], "dot": dots[q, at]})

        one = vectors.select("id", "embedding").mapInPandas(run, f"qid {kinds[0]}, id {kinds[1]}, dot double")
        out = one if out is None else out.union(one)
    order = Window.partitionBy("qid").orderBy(F.col("dot").desc(), "id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
