import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def words(text):
    return WORD.findall((text or "").translate(LOW))


def texts(spark, rows, ddl="doc_id long, text string"):
    return spark.createDataFrame(rows, ddl)


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


ODD = [
    (0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, "Éa ß one, two! three four"), (4, "Éa ß one, two! three four"), (None, "a null id"),
    (5, "###"), (6, "word " * 3000), (7, "The quick brown fox jumps over the lazy dog again and again."),
    (8, "▁ a  b c \x00 \U0001f600 <|endoftext|> <s>"), (-9, "below zero"),
]
