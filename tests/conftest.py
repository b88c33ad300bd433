import pytest

from tilecast.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def demand(spark):
    """Two places over days 1 to 15, sparse, in shuffled order."""
    rows = []
    for place, scale in (("qp02yc", 1.0), ("qp0dnh", 3.0)):
        for day in range(1, 16):
            for tick in range(96):
                if (7 * day + 3 * tick) % 5 < 3:
                    value = scale * (1 + day % 7 + (tick % 32) / 8)
                    rows.append((place, day, f"{tick // 4}:{15 * (tick % 4)}", value))
    rows.sort(key=lambda r: hash((r[1] * 31 + len(r[2]), r[3], r[0] == "qp02yc")))
    return spark.createDataFrame(
        rows, "geohash6 string, day int, timestamp string, demand double"
    ).cache()
