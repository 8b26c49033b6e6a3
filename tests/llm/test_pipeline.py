"""The pipeline's stages against brute force, each on what its predecessor kept."""

from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from test_text_operators import brute_components, near_links, shingle_sets, table

import corpus_pipeline
from tidemark.llm import mixing
from tidemark.llm.language import languages
from tidemark.llm.quality import quality_scores

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "quality", "near_dedup", "mixing", "encoding"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame([(10**6, "12 ### 34", "en", "src0", 9)], docs.schema))

    def written(name, frame):
        frame.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    wanted = languages(docs).where("lang_pred != 'und' and score >= 0.51")
    one = written("language", stages["language"](spark, docs, SMALL))
    assert ids(one) == ids(wanted) and 10**6 not in ids(one) and one.columns == docs.columns

    wanted = quality_scores(one, spark.read.parquet(f"{SMALL}/labels.parquet")).where("score >= 0.5")
    two = written("quality", stages["quality"](spark, one, SMALL))
    assert ids(two) == ids(wanted) and 0 < two.count() < one.count() and two.columns == docs.columns

    sets = shingle_sets([(r.doc_id, r.text) for r in two.collect()])
    component = brute_components(sets, near_links(sets))
    three = written("near_dedup", stages["near_dedup"](spark, two, SMALL))
    assert ids(three) == Counter(i for i, c in component.items() if i == c) and three.columns == docs.columns

    four = written("mixing", stages["mixing"](spark, three, SMALL))
    planned = mixing.plan(three, whole=True).collect()
    assert ids(four) == Counter({r.doc_id: len(r.placements) for r in planned if r.placements}) and four.columns == docs.columns
    taken, targets, longest = Counter(), {}, Counter()
    for r in planned:
        taken[r.source] += r.taken
        targets[r.source] = r.target
        longest[r.source] = max(longest[r.source], r.size)
    assert all(abs(taken[s] - t) <= longest[s] / 2 + 1 for s, t in targets.items())

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    five = stages["encoding"](spark, four, SMALL).collect()
    text = {r.doc_id: r.text for r in four.collect()}
    assert len(five) == four.count()
    assert all(np.frombuffer(r.ids_le, "<u4").tolist() == sp.encode(text[r.doc_id], add_bos=True, add_eos=True) and r.n_tokens == len(r.ids_le) // 4 for r in five)


AWKWARD = [
    (1, None, None, None), (2, "", "en", "a"), (3, "some words of text here", "en", None), (3, "some words of text here", "en", None), (None, "some words of text here", "en", "a"), (None, "other words stand in this row", "en", "a"),
    (3, "quite another text under an id that is taken", "en", "a"), (None, None, "en", "a"), (9, "12 ## 34", "en", "a"), (10, "SOME words of  text here", "de", "b"),
]


def stored(spark, rows, folder):
    """A table of documents with the labels of the smallest one."""
    table(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_near_copies_of_awkward_rows(spark, tmp_path):
    """Rows without doc_id and with one that others have are documents each; of copies the smallest doc_id stays, and none without."""
    docs = spark.read.parquet(stored(spark, AWKWARD, tmp_path) + "/documents.parquet")
    wanted = sorted([(1, None), (2, ""), (3, "some words of text here"), (3, "quite another text under an id that is taken"), (9, "12 ## 34")], key=str)
    for again in (docs, table(spark, AWKWARD)):
        kept = corpus_pipeline.without_near_copies(spark, again, SMALL)
        assert kept.columns == again.columns
        found = Counter((r.doc_id, r.text) for r in kept.collect())
        assert {(i, t): n for (i, t), n in found.items() if i is not None} == Counter(wanted)
        assert {t: n for (i, t), n in found.items() if i is None} == {None: 1, "other words stand in this row": 1}
    assert corpus_pipeline.without_near_copies(spark, docs.where("false"), SMALL).count() == 0


def test_run_of_awkward_and_empty_tables(spark, tmp_path):
    rows = corpus_pipeline.run(spark, stored(spark, AWKWARD, tmp_path / "awkward")).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    coded = {(i, tuple(sp.encode(t, add_bos=True, add_eos=True))) for i, t, _, _ in AWKWARD if t}
    assert rows and all((r.doc_id, tuple(np.frombuffer(r.ids_le, "<u4").tolist())) in coded for r in rows)
    assert all(r.n_tokens == len(r.ids_le) // 4 for r in rows) and not {1, 2, 9} & {r.doc_id for r in rows}
    assert corpus_pipeline.run(spark, stored(spark, [], tmp_path / "empty")).collect() == []


def test_stages_of_awkward_rows(spark):
    docs = table(spark, AWKWARD)
    stages = dict(corpus_pipeline.STAGES)
    assert {r.text for r in stages["language"](spark, docs, SMALL).collect()} <= {t for _, t, _, _ in AWKWARD if t and any(map(str.isalpha, t))}
    wanted = Counter((r.doc_id, r.kept_text) for r in quality_scores(docs, spark.read.parquet(f"{SMALL}/labels.parquet"), keep=docs.columns).where("score >= 0.5").collect())
    assert Counter((r.doc_id, r.text) for r in stages["quality"](spark, docs, SMALL).collect()) == wanted
    planned = mixing.plan(docs, whole=True, keep=["text"]).collect()
    assert Counter((r.doc_id, r.text) for r in stages["mixing"](spark, docs, SMALL).collect()) == sum((Counter({(r.doc_id, r.kept_text): len(r.placements)}) for r in planned), Counter())
    assert stages["encoding"](spark, docs, SMALL).count() == len(AWKWARD)
    for stage in stages.values():
        assert stage(spark, docs.where("false"), SMALL).count() == 0
