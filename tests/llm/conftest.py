import hashlib
import zlib

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def crc(value) -> int:
    return zlib.crc32(str(value).encode())
