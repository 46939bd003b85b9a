from larkspur.session import SETTINGS, session


def test_settings(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    made = session(spark__sql__broadcastTimeout="301")
    try:
        assert made.conf.get("spark.sql.session.timeZone") == "UTC" and made.conf.get("spark.sql.broadcastTimeout") == "301"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.conf.unset("spark.sql.broadcastTimeout")
