from __future__ import annotations

import random

from pyspark.sql import functions as F

from tallyloom.llm import garbled

WORDS = ["학과정원", "현황", "조회", "결과", "등록금", "장서", "예산", "입학", "년", "기숙사", "취업"]
COMMON = frozenset("".join(WORDS))
CLEAN = [
    "2024년 학과정원.xlsx", "São_João «resumo».xlsx", "Évaluation_des_diplômés", "Øversigt.xlsx", "大学一覧_2024年度.xlsx", "ﾃﾞｰﾀ_2022.xlsx", "Статистика", "µ³_단위표", "Café±5%", "§3 ×배율 표",
    "졸업자 現状 비교", "學科別(개정)", "ㄱㄴㄷ순", "2023%EB%85%84.xlsx", "&#45380;.xlsx", "=?UTF-8?B?6rCA?= .xlsx", "why_so_few?_faq", "왜 줄었나?_2020", "학과정원", "Ｒｅｐｏｒｔ", "", None, "plain.xml",
]


def test_clean_names():
    assert [n for n in CLEAN if garbled.inspect(n, COMMON)] == []


def test_round_trip():
    random.seed(1)
    kept = 0
    for chain in garbled.BYTE_CHAINS + tuple((c,) for c in garbled.WIDE_CHAINS):
        for _ in range(30):
            name = "2024_" + "_".join(random.sample(WORDS, 3)) + ".xlsx"
            try:
                broken = garbled.garble(name, chain)
                if broken.encode(chain[-1][1] if chain[-1][1] != "cp1252" else "utf-8") is None:
                    continue
            except UnicodeError:
                continue
            found = garbled.inspect(broken, COMMON)
            assert found is not None, (chain, name, broken)
            assert found[0] == name, (chain, name, broken, found)
            kept += 1
    assert kept > 300


def test_mixed_text_stays():
    for chain in garbled.BYTE_CHAINS:
        broken = "2024년 " + garbled.garble("등록금", chain) + " 현황 São.xlsx"
        assert garbled.inspect(broken, COMMON)[0] == "2024년 등록금 현황 São.xlsx", chain


def test_losses():
    for name in ("2019�� ����.xlsx", "??? ??_2023.xml", "2025? ??(1).xml", "_?_.xml", "25? ?????????(4?).xlsx", "0009754_????_2020.xml"):
        assert garbled.inspect(name, COMMON) == (None, "lost characters")
    assert garbled.inspect("a\x85b가", COMMON) == (None, "control characters")
    assert garbled.inspect(garbled.garble("등록금", garbled.BYTE_CHAINS[0]) * 20_000, COMMON)[0] == "등록금" * 20_000


def test_ordinary_question_marks():
    for name in ("등록금 what??", "2024 (?)", "학과 Q&A??", "왜 줄었나?", "정원(2024)?", "왜?! 학과", "등록금 얼마 ?", "현황 100%?"):
        assert garbled.inspect(name, COMMON) is None, name
    broken = garbled.garble("등록금", garbled.BYTE_CHAINS[0])
    assert garbled.inspect(f"{broken} what??", COMMON) == ("등록금 what??", "garbled sequence")
    assert garbled.inspect(f"{broken} ??_2023", COMMON) == ("등록금 ??_2023", "garbled sequence, lost characters")


def test_characters_of_all_kinds():
    names = ["Don’t stop… – it’s", "“Resumé”", "Việt Nam", "Ελλάδα στατιστικά", "Статистика вузов", "ㄱㄴㄷ", "100€ · 5°", "大学一覧", "データ", "ﬁn™", "łódź władza", "שלום", "ภาษาไทย", "📚 책", "①②"]
    for chain in garbled.BYTE_CHAINS[:8]:
        for name in names:
            try:
                broken = garbled.garble(name, chain)
            except UnicodeError:
                continue
            found = garbled.inspect(broken, COMMON)
            assert found is not None, (chain, name, broken)
            if chain[0][1] in ("latin-1", "cp1252") and name != "ﬁn™":
                assert found[0] == name, (chain, name, broken, found)


def test_one_byte_for_a_letter():
    for right, word in (("cp1251", "Статистика"), ("koi8-r", "статистика"), ("iso8859-7", "στατιστικα")):
        broken = word.encode(right).decode("latin-1")
        assert garbled.inspect(f"2024 {broken}.xlsx", COMMON)[0] == f"2024 {word}.xlsx", (right, broken)
    for name in ("Éé", "ÀÉÎ", "naïveté", "«École»", "“Ärger” – Øre", "Åß", "résumé", "Ðorğan"):
        assert garbled.inspect(name, COMMON) is None, name


def test_right_text_beside_a_wide_sequence():
    broken = garbled.garble("취업", (("utf-8", "cp949"),))
    assert garbled.inspect(f"현황{broken}", COMMON)[0] == "현황취업"
    assert garbled.inspect(f"학과 현황{broken} 조회.xlsx", COMMON)[0] == "학과 현황취업 조회.xlsx"


def test_common_syllables_at_every_size(spark):
    few = spark.createDataFrame([("학과",), ("학교",), ("São",), (None,)], "name string")
    assert garbled.common_syllables(few) == frozenset("학과교")
    many = few.crossJoin(spark.range(2000)).select("name").unionByName(spark.createDataFrame([("뷁",)], "name string"))
    assert garbled.common_syllables(many) == frozenset("학과교")
    assert garbled.common_syllables(few.limit(0)) == frozenset()


def test_without_clean_names():
    assert garbled.inspect(garbled.garble("등록금 현황", garbled.BYTE_CHAINS[8]), frozenset())[0] == "등록금 현황"


def test_find(spark, rows):
    broken = garbled.garble("등록금", garbled.BYTE_CHAINS[0])
    data = [("t", 1, broken), ("t", 1, broken), ("t", None, None), ("u", 2, "등록금"), (None, 3, "�")]
    df = spark.createDataFrame(data, "table_name string, row_id long, name string").withColumns({"restored": F.lit(1), "c": F.lit(2)})
    assert rows(garbled.find_garbled(df), "table_name", "row_id", "restored") == sorted([("t", 1, "등록금"), ("t", 1, "등록금"), (None, 3, None)], key=repr)
    assert garbled.find_garbled(df.limit(0)).count() == 0
