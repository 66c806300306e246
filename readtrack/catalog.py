"""The book catalogue: 66 books, their chapters and the names people write for them."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Name | chapters | further names, in canonical order. The first 39 are of the old testament.
BOOKS = """
Kejadian|50|kej
Keluaran|40|kel
Imamat|27|ima,im
Bilangan|36|bil
Ulangan|34|ul
Yosua|24|yos
Hakim-hakim|21|hak,hakim,hakim2
Rut|4|ruth
1 Samuel|31|1samuel,1 sam,1sam,i samuel,i sam
2 Samuel|24|2samuel,2 sam,2sam,ii samuel,ii sam
1 Raja-raja|22|1 raja - raja,1raja-raja,1 raj,1raja,1raj,1 raja,1 raja2
2 Raja-raja|25|2 raja - raja,2raja-raja,2 raj,2raja,2raj,2 raja,2 raja2
1 Tawarikh|29|1tawarikh,1 tawarik,1 taw,1taw
2 Tawarikh|36|2tawarikh,2 tawarik,2 taw,2taw
Ezra|10|ez,ezr
Nehemia|13|neh
Ester|10|est
Ayub|42|ayb,ay
Mazmur|150|maz,mzm,mazm
Amsal|31|ams
Pengkhotbah|12|pengkotbah,peng,pkh
Kidung Agung|8|kidungagung,kid,kid agung
Yesaya|66|yes
Yeremia|52|yer
Ratapan|5|rat
Yehezkiel|48|yeh,yehez,yehz
Daniel|12|dan
Hosea|14|hos
Yoel|3|yl
Amos|9|amo,am
Obaja|1|oba,ob
Yunus|4|yun
Mikha|7|mik,mikh
Nahum|3|nah
Habakuk|3|hab
Zefanya|3|zef
Hagai|2|hag
Zakharia|14|zakaria,zak,za
Maleakhi|4|mal,maleaki
Matius|28|mat
Markus|16|mrk,mar,mk,mark
Lukas|24|luk,lk
Yohanes|21|yoh,joh
Kisah Para Rasul|28|kisahpararasul,kisah,kis,kisah rasul,kpr
Roma|16|rom,rm
1 Korintus|16|1korintus,1 kor,1kor
2 Korintus|13|2korintus,2 kor,2kor
Galatia|6|gal
Efesus|6|efes,ef,efs
Filipi|4|fil,flp
Kolose|4|kol
1 Tesalonika|5|1tesalonika,1 tes,1tes
2 Tesalonika|3|2tesalonika,2 tes,2tes
1 Timotius|6|1timotius,1 tim,1tim
2 Timotius|4|2timotius,2 tim,2tim
Titus|3|tit
Filemon|1|flm,film
Ibrani|13|ibr
Yakobus|5|yak
1 Petrus|5|1petrus,1 pet,1pet
2 Petrus|3|2petrus,2 pet,2pet
1 Yohanes|5|1yohanes,1 yoh,1yoh
2 Yohanes|1|2yohanes,2 yoh,2yoh
3 Yohanes|1|3yohanes,3 yoh,3yoh
Yudas|1|yud
Wahyu|22|wah,why
"""
OLD = 39


@lru_cache(1)
def books() -> list[tuple[int, str, int, list[str], str]]:
    """(book_id, name, chapters, aliases, testament); a book's first alias is its own lower-case name."""
    out = []
    for i, line in enumerate(BOOKS.split("\n")[1:-1], 1):
        name, chapters, more = line.split("|")
        out.append((i, name, int(chapters), [name.lower(), *more.split(",")], "old" if i <= OLD else "new"))
    return out


@lru_cache(1)
def aliases() -> list[tuple[str, int, int]]:
    """(alias, alias_ord, book_id) in the catalogue's order."""
    pairs = [(a, b[0]) for b in books() for a in b[3]]
    return [(a, i, b) for i, (a, b) in enumerate(pairs)]


def book_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n, c, t) for i, n, c, _, t in books()], "book_id int, name string, chapters int, testament string")


def alias_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(aliases(), "alias string, alias_ord int, book_id int")


def name_of(book_id: Column) -> Column:
    return F.get(F.array(*[F.lit(b[1]) for b in books()]), book_id.cast("int") - 1)


def chapters_of(book_id: Column) -> Column:
    return F.get(F.array(*[F.lit(b[2]) for b in books()]), book_id.cast("int") - 1)


def books_sql() -> str:
    """The catalogue as a CTE for oracle SQL: cat(book_id, name, chapters, aliases)."""
    rows = ", ".join(f"({i}, '{n}', {c}, [{', '.join(repr(a) for a in al)}])" for i, n, c, al, _ in books())
    return f"cat(book_id, name, chapters, aliases) AS (VALUES {rows})"
