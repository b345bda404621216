from pyspark.sql import functions as F

from clickloom.functions import dates, records, text


def _one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_text(spark):
    lit = F.lit
    row = _one(spark, both=text.trim_comma(lit(",a,b,")), left=text.trim_comma(lit(",a")),
               none=text.trim_comma(lit("a,b")), two=text.two_digits(lit("7")),
               twelve=text.two_digits(lit("12")), ids=text.id_list(lit("1, 20,3")),
               empty=text.csv_or_null(F.array().cast("array<string>")),
               json=text.json_value(lit('{"product_status": 1}'), "product_status"),
               half=text.round_half_up(lit(0.285), 2),
               city=text.concat_long_string(lit(3), lit("Rome"), ":"))
    assert row.asDict() == {"both": "a,b", "left": "a", "none": "a,b", "two": "07",
                            "twelve": "12", "ids": [1, 20, 3], "empty": None, "json": "1",
                            "half": 0.29, "city": "3:Rome"}


def test_records(spark):
    record = F.lit("age=28|kw=|city=city81|age=30|odd=a=b")
    row = _one(spark, age=records.get_field(record, "age"), kw=records.get_field(record, "kw"),
               city=records.get_field(record, "city"), absent=records.get_field(record, "x"),
               odd=records.get_field(record, "odd"),
               dotted=records.get_field(F.lit("a=1.b=2"), "b", "."),
               changed=records.set_field(record, "city", F.lit("Rome")))
    assert row.asDict() == {"age": "28", "kw": None, "city": "city81", "absent": None,
                            "odd": None, "dotted": "2",
                            "changed": "age=28|kw=|city=Rome|age=30|odd=a=b"}


def test_dates(spark):
    late, early = F.lit("2024-03-01 10:00:05"), F.lit("2024-02-29 23:59:59")
    row = _one(spark, hour=dates.date_hour(late), before=dates.before(early, late),
               after=dates.after(early, late), minus=dates.minus_seconds(late, early),
               minute=dates.minute_key(dates.parse_time(late)),
               day=dates.format_date(dates.parse_date_key(F.lit("20240229"))))
    assert row.asDict() == {"hour": "2024-03-01_10", "before": True, "after": False,
                            "minus": 36006, "minute": "202403011000", "day": "2024-02-29"}
