"""The pipeline's near-copy stage against brute force, and rows with null or repeated ids."""

import random

import corpus_pipeline

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def brute_sets(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_first(texts):
    """Positions of the first text of each component of pairs at 0.8 or more."""
    sets, label = [brute_sets(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) > 0:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return sorted(set(label))


def test_near_copies_are_those_of_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(200)]
    line = rng.choices(vocabulary, k=30)  # in many texts that are no copies
    texts = [None, "", " \t", "one", "One", "a b c d e", "a b c d f"]
    for n in range(40):
        base = rng.choices(vocabulary, k=rng.randint(10, 150)) + line * (n % 3 == 0)
        texts.append(" ".join(base))
        for _ in range(12 if n == 0 else 4):
            copy = list(base)
            for _ in range(rng.randint(1, 5)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = [f"new{rng.randrange(999)}"]
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOC)
    kept = corpus_pipeline.near_dedup_stage(spark, docs, "")
    want = brute_first(texts)
    assert sorted(r.doc_id for r in kept.collect()) == want
    assert kept.columns == docs.columns and len(want) < len(texts) - 50
    assert corpus_pipeline.near_dedup_stage(spark, docs.limit(0), "").count() == 0


def test_pipeline_keeps_texts_with_null_and_repeated_ids(spark):
    rows = [(None, "one text of its own words", "en", "s", 1), (None, "quite another text than that", "en", "s", 1), (5, "a b c d e f g", "en", "s", 1), (5, "h i j k l m n", "en", "s", 1)]
    rows += [(4, "h i j k l m n", "en", "s", 1), (None, "a b c d e f g", "en", "s", 1), (5, "a b c d e f g", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOC)
    for kept in (corpus_pipeline.near_dedup_stage(spark, docs, ""), corpus_pipeline.near_dedup_stage(spark, docs.repartition(3), "")):
        assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("4", rows[3][1]), ("5", rows[2][1]), ("None", rows[0][1]), ("None", rows[1][1])]


def test_only_small_tables_are_sent(spark):
    """A driver of 750 MB heap holds several sent tables at a time: a million rows of 40 bytes are not sent."""
    from sourceground.llm import near_copies
    from sourceground.llm.common import materialize

    sent = lambda n: "Broadcast" in near_copies._small(materialize(spark.range(n), "sent"), 40).join(spark.range(5), "id")._jdf.queryExecution().sparkPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sent(1000) and not sent(1_000_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
