"""What the similarity join moves: rows of posting lists name their document, not its bitmaps."""

from orderloom.llm import ngram_join


def test_rows_of_lists_carry_no_bitmaps_before_pairs_are_made(spark, monkeypatch):
    stored, collections = {}, []
    keep = ngram_join.handed_over

    def recorded(df, purpose="rows"):
        stored.setdefault(purpose, []).append((set(df.columns), df._jdf.queryExecution().analyzed().toString()))
        return keep(df, purpose)

    monkeypatch.setattr(ngram_join, "handed_over", recorded)
    monkeypatch.setattr(ngram_join, "collected", lambda session: collections.append(session))
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join([*words, "more"]), " ".join(words[:-1] + ["else"]),
             " ".join(f"v{i}" for i in range(40)), "alone", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = {r.doc_id: r.component_id for r in ngram_join.similar_groups(docs).collect()}
    assert groups == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5}
    wide = {*ngram_join.BITS, *ngram_join.LISTS, "_names", *[f"_p{c}" for c in (*ngram_join.BITS, *ngram_join.LISTS)]}
    assert len(stored["pivots"]) == ngram_join.ROUNDS
    for purpose in ("live", "pivots", "placed", "in-mixed"):
        assert not any(columns & wide for columns, _ in stored.get(purpose, [])), purpose
    # postings of shingles that one document has are left out before they are shuffled
    assert "_words" in stored["live"][0][1] and len(stored["shared-filter"]) == 1
    assert len(collections) == ngram_join.ROUNDS + 1
