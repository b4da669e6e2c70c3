"""Exact and near duplicate pages (DUP-1..4, JOI-5, JOI-6, AGG-4, WIN-1).

Near duplicates follow a sequential rule: a page is compared with the earlier
pages that were kept; of these the one with the most common shingles (ties: the
shorter one) is its candidate, and the page is a duplicate when the Jaccard
similarity with that candidate is above the threshold.

The job reaches the same marks without going page by page and without ever
pairing the members of a group of copies with each other:

1. Shingles that occur on one page only cannot match. The shared ones are put in
   order of document frequency per page (``rank_shingles``); what is moved for that are
   blocks of shingles, not rows (``ranking``).
2. Two pages with J > t share one of their rarest ``n - ceil(t n) + 1`` shingles.
   A page none of whose rare shingles occurs on an earlier page of fitting length
   is kept for certain. This is a minimum per shingle, not a list of pairs. Of the
   shingles that are rare on the same pages one is enough (``_one_of_each_list``).
3. Rounds: the open pages meet only the pages *kept* in the round before. One kept
   page settles its whole group of copies, so pairs grow with pages, not squared.
4. A page with a similar kept page may still be won over by a longer page that
   holds even more of its shingles. Any such page holds one of the page's
   ``n - common`` rarest shingles, which for a close copy is next to none.
5. Once the open pages have few enough pairs among themselves (in proportion to
   the rare shingles), these are all compared at once, and what is left of the rounds
   works on a narrow table of pairs (``_settle``).

Joins on a shingle are spread by its document frequency, which is known.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgraph_spark.functions import markup, shingles
from webgraph_spark.operators import ranking
from webgraph_spark.operators.skew import spread_join
from webgraph_spark.schemas import LIMITS
from webgraph_spark.session import cut_lineage

# Rows of one shingle that one part of a spread join takes.
ROWS_PER_PART = 100_000

# Pairs that open pages may have with each other, as a multiple of all rare shingles, or in all, to be compared at once.
PAIRS_PER_TOKEN = 4
FEW_PAIRS = 100_000

# Guards prefix and length limits against rounding; pairs are verified exactly.
_SLACK = 1e-9


def page_signatures(pages: DataFrame, k: int = LIMITS.shingle_words) -> DataFrame:
    """(id, ord, hash, hash_length) of pages (id, ord, html_content)."""
    text = pages.select("id", "ord", markup.strip_markup(F.col("html_content")).alias("text"))
    return text_signatures(text, k)


def text_signatures(texts: DataFrame, k: int = LIMITS.shingle_words) -> DataFrame:
    """(id, ord, hash, hash_length) of texts (id, ord, text)."""
    return shingles.with_sets(texts.select("id", "ord", "text"), "text", k)


# --- exact duplicates -------------------------------------------------------


def first_by_hash(pages: DataFrame) -> DataFrame:
    """(hash_content, first_id, copies) of pages (id, ord, hash_content)."""
    known = pages.where("hash_content is not null")
    return known.groupBy("hash_content").agg(
        F.min(F.struct("ord", "id")).getField("id").alias("first_id"), F.count(F.lit(1)).alias("copies")
    )


def stored_duplicates(pages: DataFrame, stored: DataFrame) -> DataFrame:
    """(id, matched_id) of pages whose content hash is among ``stored`` (id, ord, hash_content), the first of them."""
    firsts = first_by_hash(stored).select("hash_content", F.col("first_id").alias("matched_id"))
    found = spread_join(pages.select("id", "hash_content"), firsts, ["hash_content"], "inner", ["id"])
    return found.select("id", "matched_id")


def exact_duplicates(pages: DataFrame) -> DataFrame:
    """(id, matched_id) of every page but the first with the same content hash.

    The first of each hash is an aggregate; only hashes with copies are looked
    up again, and a hash with very many copies is spread.
    """
    repeated = first_by_hash(pages).where("copies > 1")
    found = spread_join(
        pages.select("id", "hash_content"),
        repeated.select("hash_content", F.col("first_id").alias("matched_id")),
        ["hash_content"],
        "inner",
        ["id"],
        counts=repeated,
        rows="copies",
    )
    return found.where("id <> matched_id").select("id", "matched_id")


# --- shingle tables ---------------------------------------------------------


def explode_signatures(sigs: DataFrame, *keep: str | Column) -> DataFrame:
    return sigs.select(*keep, F.explode("hash").alias("shingle"))


def shingle_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """(a_id, b_id, common) for every page of ``a`` and stored page of ``b`` with a common shingle.

    ``b`` is the larger side; a shingle on very many of its pages is spread.
    """
    left = explode_signatures(a.withColumnRenamed("id", "a_id"), "a_id")
    right = explode_signatures(b.withColumnRenamed("id", "b_id"), "b_id")
    common = spread_join(right, left, ["shingle"], "inner", ["b_id"])
    return common.groupBy("a_id", "b_id").agg(F.count(F.lit(1)).alias("common"))


def lateral_overlap_count(a: DataFrame, b: DataFrame, pairs: DataFrame) -> DataFrame:
    """AGG-4: (a_id, b_id, common) of given pairs, from the two stored sets."""
    own = a.select(F.col("id").alias("a_id"), F.col("hash").alias("_a"))
    other = b.select(F.col("id").alias("b_id"), F.col("hash").alias("_b"))
    both = spread_join(pairs.select("a_id", "b_id"), other, ["b_id"], "inner", ["a_id"])
    both = spread_join(both, own, ["a_id"], "inner", ["b_id"])
    return both.select("a_id", "b_id", F.size(F.array_intersect("_a", "_b")).cast("bigint").alias("common"))


def best_overlap(pairs: DataFrame) -> DataFrame:
    """WIN-1: per a_id the b_id with most common shingles, ties by shorter b, then smaller id.

    pairs has a_id, b_id, common, b_length.
    """
    best = F.min(F.struct((-F.col("common")).alias("_less"), "b_length", "b_id")).alias("_best")
    return pairs.groupBy("a_id").agg(best).select(
        "a_id", F.col("_best.b_id").alias("b_id"), (-F.col("_best._less")).alias("common"), "_best.b_length"
    )


def rank_shingles(sigs: DataFrame, *keep: str) -> DataFrame:
    """(id, ord, n, *keep, shared), written: shared is the page's array of (df, shingle), rarest first.

    Pages without a shared shingle are left out: nothing can match them. Rows of one page that come again are put together.
    """
    ranked = cut_lineage(ranking.rank_packed(sigs, *keep), "ranked")
    page = ["id", "ord", "n", *keep]
    if ranked.groupBy(*page).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").isEmpty():
        return ranked
    again = ranked.groupBy(*page).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("shared")))).alias("shared"))
    return cut_lineage(again, "ranked")


def _rarest(count: Column) -> Column:
    # The page's own shingles come before the shared ones and match nobody.
    own = F.col("n") - F.size("shared")
    return F.slice("shared", F.lit(1), F.greatest(F.lit(0), F.least(count - own, F.size("shared"))).cast("int"))


def _prefix_length(n: Column, threshold: float) -> Column:
    needed = F.greatest(F.lit(1.0), F.ceil(n * threshold - n * _SLACK - _SLACK))
    return n - needed + 1


def _prefix(threshold: float) -> Column:
    return _rarest(_prefix_length(F.col("n"), threshold))


def _parts(df: Column) -> Column:
    return F.ceil(df / ROWS_PER_PART).cast("int")


def _spread(rows: DataFrame) -> DataFrame:
    """Rows (id, df, shingle, ...) with the part of their shingle they belong to."""
    return rows.withColumn("_part", F.pmod(F.xxhash64("id"), _parts(F.col("df"))).cast("int"))


def _repeat(rows: DataFrame) -> DataFrame:
    """Rows (df, shingle, ...) once for every part of their shingle."""
    return rows.withColumn("_part", F.explode(F.sequence(F.lit(0), _parts(F.col("df")) - 1)))


def _tokens(ranked: DataFrame, array: Column, *keep: str) -> DataFrame:
    return ranked.select(*keep, F.inline(array)).withColumnRenamed("shingle", "token")


def _one_of_each_list(rare: DataFrame) -> DataFrame:
    """Rows (id, ..., df, token) of one token of all that the same pages hold, if more than one page does; written.

    Which pages meet does not change by that, only how often. Lists of pages are known by 128 bits.
    """
    hashes = [F.xxhash64("id", F.lit(salt)) for salt in range(2)]
    # Sums of 32 bits do not overflow.
    halves = [half for h in hashes for half in (h.bitwiseAND(F.lit(2**32 - 1)), F.shiftrightunsigned(h, 32))]
    sums = [F.sum(half).alias(f"_list{i}") for i, half in enumerate(halves)]
    held = rare.groupBy("token").agg(F.count(F.lit(1)).alias("pages"), *sums).where("pages > 1")
    held = cut_lineage(held, "lists")
    one = held.groupBy("pages", *(f"_list{i}" for i in range(len(sums)))).agg(F.min("token").alias("token")).select("token")
    return cut_lineage(spread_join(rare, one, ["token"], "left_semi", ["id"], counts=held, rows="pages"), "rare")


def _lengths_fit(a: Column, b: Column, threshold: float) -> Column:
    t = threshold - _SLACK
    return (a > b * t) & (b > a * t)


def _length_class(n: Column, threshold: float) -> Column:
    # Lengths that fit differ by a factor below 1/t, so by at most one class.
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(1.0 / (threshold - _SLACK)))).cast("int")


def _order_of(prefix: str = "") -> Column:
    return F.struct(F.col(f"{prefix}ord").alias("ord"), F.col(f"{prefix}id").alias("id"))


def _has_earlier(pages: DataFrame, others: DataFrame, threshold: float) -> DataFrame:
    """Ids of ``pages`` that share a rare shingle with an earlier page of ``others`` of fitting length.

    Per shingle and length class only the earliest page is kept, so a shingle
    on a third of all pages costs one row per class. May name a page too many,
    never one too few. Both sides have id, ord, n, df, token.
    """
    classed = others.withColumn("_class", _length_class(F.col("n"), threshold))
    earliest = classed.groupBy("token", "_class").agg(
        F.min(_order_of()).alias("_earliest"), F.first("df").alias("df")
    )
    own_class = _length_class(F.col("n"), threshold)
    probes = pages.withColumn("_class", F.explode(F.array(own_class - 1, own_class, own_class + 1)))
    met = _spread(probes).join(_repeat(earliest.select("token", "_class", "_earliest", "df")).drop("df"),
                               ["token", "_class", "_part"])
    return met.where(F.col("_earliest") < _order_of()).select("id").distinct()


def _meet(pages: DataFrame, others: DataFrame, fits: Column) -> DataFrame:
    """Distinct pairs (id, n, other, other_n) of a page and an earlier one with a common token.

    Both sides have id, ord, n, df, token.
    """
    right = others.select(
        "token", "df", F.col("id").alias("other"), F.col("ord").alias("other_ord"), F.col("n").alias("other_n")
    )
    met = _spread(pages).join(_repeat(right).drop("df"), ["token", "_part"])
    earlier = F.struct(F.col("other_ord").alias("ord"), F.col("other").alias("id")) < _order_of()
    return met.where(earlier & fits).select("id", "n", "other", "other_n").distinct()


def _verify(pairs: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds common and similarity from pages (id, tokens); shared shingles are enough, others cannot be common."""
    own = pages.select("id", F.col("tokens").alias("_own"))
    other = pages.select(F.col("id").alias("other"), F.col("tokens").alias("_other"))
    # One kept page may be the partner of a third of all pages; a page has few partners.
    both = spread_join(pairs, other, ["other"], "inner", ["id"]).join(own, "id")
    counted = both.withColumn("common", F.size(F.array_intersect("_own", "_other"))).drop("_own", "_other")
    similarity = shingles.jaccard_from_counts(F.col("common"), F.col("n"), F.col("other_n"))
    return counted.withColumn("similarity", similarity)


def _best(pairs: DataFrame, rule: str) -> DataFrame:
    """One row (id, other, common, similarity) per page: its candidate."""
    first = F.col("common") if rule == "overlap" else F.col("similarity")
    best = F.min(F.struct((-first).alias("_less"), "other_n", "other", "common", "similarity")).alias("_best")
    return pairs.groupBy("id").agg(best).select("id", "_best.other", "_best.other_n", "_best.common", "_best.similarity")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- near duplicates --------------------------------------------------------


def near_duplicates(
    sigs: DataFrame,
    threshold: float = LIMITS.max_similarity,
    rule: str = "overlap",
    stored: DataFrame | None = None,
) -> DataFrame:
    """(id, matched_id, similarity) of the near duplicates among sigs (id, ord, hash, hash_length).

    ``stored`` holds signatures of pages kept before, all earlier than sigs.
    ``rule="max_jaccard"`` takes the most similar kept page as candidate instead
    of the one with most common shingles. Empty signatures never take part.
    """
    if rule not in ("overlap", "max_jaccard"):
        raise ValueError(f"unknown rule {rule!r}")
    columns = ["id", "ord", "hash", "hash_length"]
    everything = sigs.select(*columns).withColumn("known", F.lit(False))
    if stored is not None:
        everything = everything.unionByName(stored.select(*columns).withColumn("known", F.lit(True)))
    everything = shingles.with_packed(everything.where("hash_length > 0"))
    return _near_duplicates(cut_lineage(everything, "signatures"), threshold, rule)


def _near_duplicates(everything: DataFrame, threshold: float, rule: str) -> DataFrame:
    """``near_duplicates`` of pages (id, ord, hash as ``packed`` bytes, hash_length, known) that are cheap to read again."""
    ranked = rank_shingles(everything, "known")
    rivaling = ranked.select("id", "ord", "n", F.col("shared.shingle").alias("tokens"))
    # Similar pages share more than the others have to share at all.
    able = cut_lineage(ranked.where(F.size(_prefix(threshold)) > 0), "able")
    sets = able.select("id", F.col("shared.shingle").alias("tokens"))
    tokens = cut_lineage(_tokens(able, _prefix(threshold), "id", "ord", "n", "known"), "tokens")
    few = max(FEW_PAIRS, PAIRS_PER_TOKEN * tokens.count())
    rare = _one_of_each_list(tokens)
    fresh = rare.where("not known").drop("known")
    rare = rare.drop("known")
    suspects = cut_lineage(_has_earlier(fresh, rare, threshold), "suspects")

    nothing = ranked.sparkSession.createDataFrame([], "id bigint, matched_id bigint, similarity double")
    if suspects.isEmpty():
        return nothing

    open_pages = suspects
    kept_tokens = rare.join(suspects, "id", "left_anti")
    suspect_tokens = cut_lineage(rare.join(suspects, "id"), "suspect-tokens")
    matches: list[DataFrame] = []
    rivals: list[DataFrame] = []
    duplicates: list[DataFrame] = []
    checked: DataFrame | None = None
    fits = _lengths_fit(F.col("n"), F.col("other_n"), threshold)

    while True:
        pairs = cut_lineage(_meet(suspect_tokens, kept_tokens, fits), "pairs")
        if not pairs.isEmpty():
            found = _verify(pairs, sets).where(F.col("similarity") > threshold)
            matches.append(cut_lineage(found, "matches"))
        if open_pages.isEmpty():
            break
        gone = _union(duplicates).select("id") if duplicates else None
        open_tokens = suspect_tokens if gone is None else suspect_tokens.join(open_pages, "id")
        if _pairs_at_most(suspect_tokens, open_tokens, few):
            pairs = cut_lineage(_meet(suspect_tokens, open_tokens, fits), "pairs")
            found = cut_lineage(_verify(pairs, sets).where(F.col("similarity") > threshold), "matches")
            met = _union([*matches, found])
            rivals = []
            if rule == "overlap":
                least = met.join(open_pages, "id").groupBy("id").agg(F.min("common").alias("common"))
                rivals = [_find_rivals(cut_lineage(least, "least"), able, rivaling, gone, threshold)]
            settled = _settle(open_pages, met, rivals)
            duplicates.append(settled.where("status = 'near'"))
            kept = settled.where("status = 'kept'").select(F.col("id").alias("other"))
            matches.append(found.join(kept, "other"))
            break
        candidates = _best(_union(matches), rule) if matches else nothing.select("id", F.lit(0).alias("common"))
        matched = open_pages.join(candidates, "id")
        if rule == "overlap" and matches:
            # A rival of an earlier round stays one; only new matches are looked at.
            unseen = matched if checked is None else matched.join(checked, "id", "left_anti")
            now_checked = cut_lineage(unseen.select("id", "common"), "checked")
            rivals.append(_find_rivals(now_checked, able, rivaling, gone, threshold))
            ids = now_checked.select("id")
            checked = ids if checked is None else checked.unionByName(ids)
        decided = cut_lineage(_decide(open_pages, matched, rivals, gone, suspect_tokens, threshold), "decided")
        duplicates.append(decided.where("status = 'near'"))
        kept_tokens = suspect_tokens.join(decided.where("status = 'kept'").select("id"), "id")
        open_pages = cut_lineage(decided.where("status = 'open'").select("id"), "open")
        still = _union(duplicates).select("id").unionByName(open_pages)
        suspect_tokens = cut_lineage(rare.join(still, "id"), "suspect-tokens")

    if not matches:
        return nothing
    near = _union(duplicates).select("id")
    return near.join(_best(_union(matches), rule), "id").select("id", F.col("other").alias("matched_id"), "similarity")


def _pairs_at_most(pages: DataFrame, others: DataFrame, most: int) -> bool:
    """Whether ``_meet`` would pair at most so many rows."""
    own = pages.groupBy("token").agg(F.count(F.lit(1)).alias("own"))
    met = others.groupBy("token").agg(F.count(F.lit(1)).alias("met")).join(own, "token")
    pairs = met.agg(F.sum(F.col("own").cast("double") * F.col("met"))).first()[0]
    return pairs is None or pairs <= most


def _find_rivals(
    matched: DataFrame, able: DataFrame, pages: DataFrame, gone: DataFrame | None, threshold: float
) -> DataFrame:
    """Pairs (id, other, common): earlier pages with more common shingles but J <= threshold.

    matched has id and common, the best overlap with a similar kept page, or the least that may count. A page
    with more in common holds one of the ``n - common`` rarest shingles. Rivals are among pages (id, ord, n, tokens).
    """
    probing = able.drop("known").join(matched, "id")
    probes = cut_lineage(_tokens(probing, _rarest(F.col("n") - F.col("common")), "id", "ord", "n", "common"), "probes")
    empty = able.sparkSession.createDataFrame([], "id bigint, other bigint, common int")
    if probes.isEmpty():
        return empty
    asked = cut_lineage(probes.select("token", "df").distinct(), "asked")
    staying = pages if gone is None else pages.join(gone, "id", "left_anti")
    index = staying.select("id", "ord", "n", F.explode("tokens").alias("token")).join(asked, "token")
    shortest = (F.col("common") + 1) * (1 + threshold) / threshold - F.col("n") - 1
    pairs = cut_lineage(_meet(probes, index, F.col("other_n") >= shortest), "pairs")
    if pairs.isEmpty():
        return empty
    best = matched.select("id", F.col("common").alias("best_common"))
    verified = _verify(pairs, pages).join(best, "id")
    rivals = verified.where((F.col("common") > F.col("best_common")) & (F.col("similarity") <= threshold))
    return cut_lineage(rivals.select("id", "other", "common"), "rivals")


def _settle(open_pages: DataFrame, matches: DataFrame, rivals: list[DataFrame]) -> DataFrame:
    """(id, status) of the open pages, near or kept, from all their pairs (id, other, common) with pages not known as near.

    A page is settled once no open page can change it. Each round settles at least the first of the open pages.
    """
    pairs = matches.select("id", "other", "common", F.lit(True).alias("similar")).join(open_pages, "id")
    if rivals:
        rival_pairs = _union(rivals).select("id", "other", "common", F.lit(False).alias("similar"))
        pairs = pairs.unionByName(rival_pairs.join(open_pages, "id"))
    waiting = open_pages.select(F.col("id").alias("other"), F.lit("open").alias("status"))
    pairs = cut_lineage(pairs.join(waiting, "other", "left").withColumn("status", F.coalesce("status", F.lit("kept"))), "edges")
    lone = open_pages.join(pairs.select("id").distinct(), "id", "left_anti").select("id", F.lit("kept").alias("status"))
    settled = [lone]

    def most(status: str, similar: bool) -> Column:
        own = (F.col("status") == status) & (F.col("similar") if similar else ~F.col("similar"))
        return F.coalesce(F.max(F.when(own, F.col("common"))), F.lit(-1))

    while not pairs.isEmpty():
        state = pairs.groupBy("id").agg(
            most("kept", True).alias("match"), most("kept", False).alias("rival"),
            most("open", True).alias("open_match"), most("open", False).alias("open_rival"),
        )
        near = (F.col("match") >= 0) & (F.col("match") >= F.greatest("rival", "open_rival"))
        best = F.greatest("match", "open_match")
        kept = (best < 0) | (F.col("rival") > best)
        done = state.select("id", F.when(near, "near").when(kept, "kept").alias("status")).where("status is not null")
        done = cut_lineage(done, "settled")
        settled.append(done)
        # Pages without pairs were settled as the last round ended.
        other = done.unionByName(lone).select(F.col("id").alias("other"), F.col("status").alias("found"))
        rest = pairs.join(done.select("id"), "id", "left_anti").join(other, "other", "left")
        rest = rest.withColumn("status", F.coalesce("found", "status")).drop("found").where("status <> 'near'")
        # A page whose last match is gone is kept, also without a pair.
        left = pairs.select("id").distinct().join(done.select("id"), "id", "left_anti")
        pairs = cut_lineage(rest, "edges")
        lone = left.join(pairs.select("id").distinct(), "id", "left_anti").select("id", F.lit("kept").alias("status"))
        settled.append(lone)
    return cut_lineage(_union(settled), "settled")


def _decide(
    open_pages: DataFrame,
    matched: DataFrame,
    rivals: list[DataFrame],
    gone: DataFrame | None,
    suspect_tokens: DataFrame,
    threshold: float,
) -> DataFrame:
    """(id, status) of the open pages: near, kept, or open while an earlier open page may matter."""
    open_tokens = suspect_tokens.join(open_pages, "id")
    blocked = _has_earlier(open_tokens, open_tokens, threshold).withColumn("blocked", F.lit(True))
    state = open_pages.join(matched.select("id", F.col("common").alias("best_common")), "id", "left")
    state = state.join(blocked, "id", "left").withColumn("blocked", F.coalesce("blocked", F.lit(False)))
    if rivals:
        waiting = open_pages.select(F.col("id").alias("other"), F.lit(True).alias("is_open"))
        standing = _union(rivals)
        if gone is not None:
            standing = standing.join(gone.withColumnRenamed("id", "other"), "other", "left_anti")
        rated = standing.join(waiting, "other", "left")
        highest = rated.groupBy("id").agg(
            F.max(F.when(F.col("is_open").isNull(), F.col("common"))).alias("kept_rival"),
            F.max(F.when(F.col("is_open"), F.col("common"))).alias("open_rival"),
        )
        state = state.join(highest, "id", "left")
    else:
        none = F.lit(None).cast("int")
        state = state.withColumn("kept_rival", none).withColumn("open_rival", none)
    best = F.col("best_common")
    beaten = F.coalesce(F.col("kept_rival") > best, F.lit(False))
    threatened = F.coalesce(F.col("open_rival") > best, F.lit(False))
    status = (
        F.when(best.isNotNull() & ~beaten, F.when(threatened, "open").otherwise("near"))
        .when(F.col("blocked"), "open")
        .otherwise("kept")
    )
    return state.select("id", status.alias("status"))


def mark_duplicates(
    pages: DataFrame,
    threshold: float = LIMITS.max_similarity,
    k: int = LIMITS.shingle_words,
    rule: str = "overlap",
    text: Column | None = None,
    stored_hashes: DataFrame | None = None,
    stored_signatures: DataFrame | None = None,
) -> DataFrame:
    """(id, status, matched_id, similarity) of pages (id, ord, html_content).

    status is exact, near or kept. ``text`` replaces the text of the markup,
    for tables that hold plain texts. ``stored_hashes`` (id, ord, hash_content) holds all
    pages of earlier batches, ``stored_signatures`` (id, ord, hash, hash_length) the kept ones.
    """
    html = F.col("html_content")
    body = markup.strip_markup(html) if text is None else text
    # The only pass over the markup; a page table is mostly markup.
    read = pages.select("id", "ord", shingles.content_hash(html).alias("hash_content"), body.alias("text"))
    sigs = cut_lineage(shingles.with_sets(read, "text", k, as_bytes=True), "pages")
    exact = exact_duplicates(sigs)
    if stored_hashes is not None:
        known = cut_lineage(stored_duplicates(sigs, stored_hashes), "known")
        exact = known.unionByName(exact.join(known.select("id"), "id", "left_anti"))
    exact = cut_lineage(exact, "exact")
    columns = ["id", "ord", "hash", "hash_length"]
    first = sigs.join(exact.select("id"), "id", "left_anti").select(*columns, F.lit(False).alias("known"))
    if stored_signatures is not None:
        stored = cut_lineage(shingles.with_packed(stored_signatures.select(*columns, F.lit(True).alias("known"))), "stored")
        first = first.unionByName(stored)
    near = _near_duplicates(first.where("hash_length > 0"), threshold, rule)
    found = exact.select("id", F.lit("exact").alias("status"), "matched_id", F.lit(1.0).alias("similarity")).unionByName(
        near.select("id", F.lit("near").alias("status"), "matched_id", "similarity")
    )
    return (
        sigs.select("id")
        .join(found, "id", "left")
        .select("id", F.coalesce("status", F.lit("kept")).alias("status"), "matched_id", "similarity")
    )
