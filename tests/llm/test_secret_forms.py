"""Operator 1 trained from labelled findings of several forms, with hard negatives, measured on documents that it hasn't seen."""

import base64
import random
import uuid

import pytest

pytest.importorskip("tickerloom.llm")

from pyspark.sql import functions as F  # noqa: E402

from tickerloom.llm import secret_scan  # noqa: E402


def examples(n: int):
    """(text, value, is a secret) of each form in its usual surroundings."""
    rng = random.Random(21)
    hexes = lambda k: f"{rng.getrandbits(4 * k):0{k}x}"
    upper = lambda k: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(k))
    mixed = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(3, 9)))
    secrets = [
        ("api token = {}", lambda: hexes(40)), ("aws access key {} and", lambda: "AKIA" + upper(15) + str(rng.randrange(2, 8))), ("client secret: {}", lambda: base64.b64encode(rng.randbytes(24)).decode().replace("=", "")),
        ('password="{}"', lambda: mixed(16) + "!9"), ("github token {} for", lambda: "ghp_" + mixed(35) + "7"), ("stripe key sk_live {}", lambda: "sk_live_" + mixed(23) + "4"),
    ]
    others = [
        ("merged commit {} into", lambda: hexes(40)), ("request id {} took", lambda: str(uuid.UUID(int=rng.getrandbits(128)))), ("on the day {} we", lambda: f"20{rng.randrange(10, 30)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}"),
        ("checksum of the file md5 {} matches", lambda: hexes(32)), ("see the function {} in", lambda: "get" + "".join(word().title() for _ in range(3))), ("release version {} of", lambda: f"v{rng.randrange(9)}-{word()}-{rng.randrange(1000)}"),
    ]
    for i in range(n):
        own = i % 3 == 0
        form, value = rng.choice(secrets if own else others)
        v = value()
        prose = lambda: " ".join(word() for _ in range(rng.randrange(5, 40)))
        yield i, f"{prose()} {form.format(v)} {prose()}", v, own


def test_precision_and_recall_on_unseen_documents(spark):
    rows = list(examples(3000))
    docs = spark.createDataFrame([(i, t, "src/a") for i, t, _, _ in rows], "doc_id long, text string, source string").repartition(4)
    known = spark.createDataFrame([(i, v, float(s)) for i, _, v, s in rows], "doc_id long, secret string, label double")
    found = secret_scan.each_finding(secret_scan.with_candidates(docs), "doc_id").join(known, "doc_id").withColumn("label", F.when(F.col("value") == F.col("secret"), F.col("label")).otherwise(0.0))
    train = found.where("doc_id % 5 <> 0").select("value", "before", "after", "path", "label")
    scanner = secret_scan.fit_scanner(secret_scan.learn_vocabulary(docs.select("text")), train)
    held = secret_scan.each_finding(secret_scan.scan(docs.where("doc_id % 5 = 0"), scanner), "doc_id").where(F.col("score") >= secret_scan.THRESHOLD)
    flagged = {(r.doc_id, r.value) for r in held.select("doc_id", "value").collect()}
    wanted = {(i, v) for i, _, v, s in rows if s and i % 5 == 0}
    assert len(wanted) > 150
    right = len(flagged & wanted)
    assert right / len(flagged) >= 0.9 and right / len(wanted) >= 0.9, (right, len(flagged), len(wanted), sorted(flagged - wanted)[:5], sorted(wanted - flagged)[:5])
    print("precision", right / len(flagged), "recall", right / len(wanted))
