from touchline.llm.jaccard_join import near_documents

WORDS = [f"w{i}" for i in range(60)]
A, B, C = (" ".join(x) for x in (WORDS, [f"v{i}" for i in range(60)], [f"u{i}" for i in range(60)]))
A2 = A + " one"
B2 = B + " one"
ROWS = [(3, A), (5, A), (5, B), (7, B2), (8, A2), (9, C), (9, C), (None, C), (None, C), (11, None), (11, None)]


def test_rows_that_share_a_key_keep_their_own_links(llm):
    docs = llm.createDataFrame(ROWS, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.class_id or 0, r.component_id or 0) for r in near_documents(docs).collect())
    assert got == sorted([
        (3, 56, 3, 3), (5, 56, 3, 3), (5, 56, 5, 5), (7, 57, 7, 5), (8, 57, 8, 3), (9, 56, 9, 9), (9, 56, 9, 9),
        (0, 56, 0, 0), (0, 56, 0, 0), (11, 0, 11, 11), (11, 0, 11, 11),
    ])


def test_stage_keeps_one_row_of_each_component(llm, folder):
    import corpus_pipeline as pipeline

    rows = [(d, t, "en", "web", len(t or "")) for d, t in ROWS if t]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.near_duplicates(llm, docs, folder)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, A), (5, B), (9, C)]
