"""Texts in scripts that no learned language uses."""

import corpus_pipeline
from pyspark.sql import functions as F

from sedimenta.llm import language_id

CLEAN = {
    "en": "the house and the garden with water are near the old river", "de": "das Haus und der Garten mit Wasser sind nahe am Fluss",
    "fr": "la maison et le jardin avec de l'eau sont près de la rivière", "es": "la casa y el jardín con agua están cerca del río"}
FOREIGN = {"cyrillic": "дом и сад с водой стоят у старой реки", "han": "房子 和 花园 在 河 边", "greek": "το σπίτι και ο κήπος"}
MIXED = {"mostly en": CLEAN["en"] + " дом", "mostly cyrillic": FOREIGN["cyrillic"] + " the house"}


def docs(spark):
    rows = [(i * 4 + k, t, lang) for i in range(30) for k, (lang, t) in enumerate(CLEAN.items())]
    rows += [(1000 + k, t, None) for k, t in enumerate([*FOREIGN.values(), *MIXED.values()])]
    return spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_foreign_scripts_are_no_evidence(spark):
    found = language_id.identify(docs(spark), language_id.learn(docs(spark), F.lit(True))).collect()
    got = {r.doc_id: r for r in found}
    assert all((got[k].lang_pred, got[k].lang_score) == (lang, 1.0) for k, lang in enumerate(CLEAN))
    assert [got[1000 + k].lang_score for k in range(len(FOREIGN))] == [0.0] * len(FOREIGN)
    letters = {k: sum(c.isalpha() for c in t) for k, t in MIXED.items()}
    assert got[1003].lang_pred == "en" and got[1003].lang_score == (letters["mostly en"] - 3) / letters["mostly en"]
    assert got[1004].n_letters == letters["mostly cyrillic"] and got[1004].lang_score == 8 / letters["mostly cyrillic"]


def test_stage_rejects_foreign_scripts(spark):
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs(spark), "").collect()}
    assert kept == {*range(120), 1003}
