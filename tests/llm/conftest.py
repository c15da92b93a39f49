import pytest



@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    return [(r.doc_id, r.text) for r in rows]
