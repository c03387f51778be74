import pytest

from sentispark.operators.stem import changed_words, stem_table
from sentispark.sources.posts import literal_table

ROOTS = ["khawatir", "tuju", "makan", "gizi", "gratis", "sekolah", "bantu", "laksana", "program", "anggar", "sehat",
         "tulis", "sapu", "pukul", "ajar", "kirim", "tembak", "rasa", "baca"]
EXPECTED = {
    "kekhawatiran": "khawatir", "setuju": "tuju", "makanan": "makan", "bergizi": "gizi", "bantuan": "bantu",
    "pelaksanaan": "laksana", "anggaran": "anggar", "kesehatan": "sehat", "menulis": "tulis", "menyapu": "sapu",
    "memukul": "pukul", "belajar": "ajar", "pengiriman": "kirim", "tembakan": "tembak", "merasakan": "rasa",
    "bacalah": "baca", "bukunya": None, "membantu": "bantu", "program": "program", "sekolahku": "sekolah",
}


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_examples(spark, max_rows):
    vocab = literal_table(spark, "word", [(w,) for w in EXPECTED])
    roots = literal_table(spark, "word", [(r,) for r in ROOTS])
    stems = stem_table(vocab, roots, max_rows)
    assert {r.word: r.stem for r in stems.collect()} == {w: s for w, s in EXPECTED.items() if s}
    assert "program" not in {r.word for r in changed_words(stems).collect()}
