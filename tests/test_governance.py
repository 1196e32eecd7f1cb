from tallyforge.operators import governance as G


def test_mask_as_analyst_and_admin(spark):
    df = spark.createDataFrame([(1, "a.b@x.com", "Ann"), (2, "noat", None), (3, "@x.com", "Bo"), (4, None, "Cy")],
                               "id long, email string, first_name string")
    tagged = G.tag_pii(df, {"email": "EMAIL", "first_name": "NAME"}, ("email", "first_name"))
    analyst = sorted((r["id"], r["email"], r["first_name"]) for r in G.apply_masking(tagged, "ANALYST").collect())
    assert analyst == [(1, "****@x.com", "****MASKED****"), (2, "****", "****MASKED****"),
                       (3, "@x.com", "****MASKED****"), (4, None, "****MASKED****")]
    admin = sorted((r["id"], r["email"], r["first_name"]) for r in G.apply_masking(tagged, "Admin").collect())
    assert admin == sorted((r["id"], r["email"], r["first_name"]) for r in df.collect())


def test_tags_survive_selection(spark):
    df = spark.createDataFrame([(1, "x@y.com")], "id long, email string")
    t = G.tag(df, "email", semantic_category="EMAIL", pii="Y")
    assert ("email", "pii", "Y") in G.tags(t.select("email"))


def test_classify_detects_email_and_country_not_names(spark):
    df = spark.createDataFrame([("Ann", "a@b.com", "us"), ("Bo", "c@d.org", "GB"), ("Cy", "e@f.net", "de")],
                               "first_name string, email string, country string")
    got = {(r["column"], r["category"], r["privacy"]) for r in G.classify_columns(df).collect()}
    assert got == {("email", "EMAIL", "IDENTIFIER"), ("country", "COUNTRY", "QUASI_IDENTIFIER")}


def test_country_codes_from_tz_database():
    codes = G.iso_country_codes()
    assert len(codes) > 240 and {"US", "GB", "DE", "SG", "CA"} <= set(codes)


def test_mask_non_string_column(spark):
    df = spark.createDataFrame([(1, 42)], "id long, account long")
    t = G.tag(df, "account", pii="Y")
    r = G.apply_masking(t, "ANALYST").first()
    assert r["account"] == "****MASKED****"
    assert G.apply_masking(t, "admin").first()["account"] == 42
