import uuid

import pytest
from pyspark.sql import functions as F

from skein.functions import geometry as G
from skein.functions import hashing as H
from skein.functions import text as T
from skein.functions import vectors as V
from skein.operators import verdicts


def one(spark, *columns, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    row = tuple(v for _, v in values.values()) or (1,)
    got = spark.createDataFrame([row], schema).select(*columns).first()
    return got[0] if len(columns) == 1 else tuple(got)


def s(v):
    return ("string", v)


@pytest.mark.parametrize("text, slug", [("Hello, World!", "hello_world"), ("  --a--b  ", "a_b"), ("x" * 47 + " y", "x" * 47 + "_"), ("É", ""), (None, None)])
def test_slugify(spark, text, slug):
    assert one(spark, T.slugify(F.col("t")), t=s(text)) == slug


@pytest.mark.parametrize("name, want", [("The Old Bed (broken)", "bed"), ("Wooden Bed — damaged, north", "wooden bed"), ("A Table [v2]", "table"), ("old", ""), (None, ""), ("Tank-Top", "tank top"), ("some wooden crates", "wooden crates"), ("Several jars", "jars"), ("Stool(old)Metal", "stoolmetal"), ("(x) some jars", "some jars")])
def test_canonical_name(spark, name, want):
    assert one(spark, T.canonical_name(F.col("t"), ["old"]), t=s(name)) == want


def test_stripped_begins_anew(spark):
    rules = ["the picture shows ", "here is ", "a photo of "]
    assert one(spark, T.stripped(F.col("t"), rules), t=s("here is a photo of the picture shows here is a dog")) == "a dog"
    assert one(spark, T.stripped(F.col("t"), rules), t=s(None)) is None
    with pytest.raises(Exception, match="prefixes to strip"):
        one(spark, T.stripped(F.col("t"), ["x"], passes=3), t=s("xxxxxxxxx"))


@pytest.mark.parametrize("caption, want", [
    ("here is a wooden bed with a mattress", "Wooden Bed"), ("Broken o'hara chair-seat, near a desk", "Broken o'hara chair-seat"), ("here is ", None), ("image background", None), ("12 34 56 78", None), (None, None),
    ("bed.", "Bed"), ("note: wooden bed", "Note: Wooden Bed"), ("word " * 20, "Word Word Word Word Word Word"), ("1a2b3", None), ("an Iron gate, with", "An Iron gate"),
    ("o'hara chair-seat, near", "O'Hara Chair-Seat"),
])
def test_name_from_caption(spark, caption, want):
    assert one(spark, T.name_from_caption(F.col("t"), [r"here is\b"], r"^an? ([a-z ]+?) with\b", ["(?i)background$"]), t=s(caption)) == want


def test_keywords_and_categories(spark):
    rules = [("broken", "damaged"), ("unlit", "inactive"), ("new", "intact")]
    assert one(spark, T.first_keyword(F.col("t"), rules), t=s("a new and broken bed")) == "damaged"
    assert one(spark, T.worst_keyword(F.col("t"), rules, ("inactive", "damaged", "intact")), t=s("a sunlit broken crate")) == "inactive"
    assert one(spark, T.worst_keyword(F.col("t"), rules, ("damaged",)), t=s("crate")) is None
    assert one(spark, T.worst_keyword(F.col("t"), rules, ("unknown",)), t=s("a new and broken bed")) == "damaged"
    chairs = [(r"\b(?:chair|bench)s?\b", ("furniture", "chair")), (r"\b(?:desk|table)s?\b", ("furniture", "table"))]
    assert one(spark, T.categories(F.col("t"), chairs), t=s("A broken metal chair near a desk")) == ["furniture", "chair", "table"]
    assert one(spark, T.categories(F.col("t"), chairs), t=s("shelves and benches")) == []


@pytest.mark.parametrize("given, want", [
    (["red", "worda"], ["red", "worda", *(f"word{c}" for c in "bcdefghijk"), "extra"]), ([f"g{i}" for i in range(12)], [*(f"g{i}" for i in range(12)), "worda", "extra", "red"]),
    ([f"g{i}" for i in range(14)], [*(f"g{i}" for i in range(14)), "worda", "extra", "red"]), (["red", "red"], ["red", "red", *(f"word{c}" for c in "abcdefghij"), "extra"]), (None, [*(f"word{c}" for c in "abcdefghijkl"), "extra", "red"]),
])
def test_caption_tags_cap_before_categories(spark, given, want):
    text = " ".join(f"Word{c}" for c in "abcdefghijklmnop") + " the of " + "x" * 40
    assert one(spark, T.caption_tags(F.col("t"), F.col("g"), ["the"], F.array(F.lit("extra"), F.lit("red"))), t=s(text), g=("array<string>", given)) == want


def test_content_words_cut_accents(spark):
    assert one(spark, T.content_words(F.col("t"), ["with"]), t=s("élanique Bed with slat-ted tree tree")) == ["lanique", "slat-ted", "tree"]


@pytest.mark.parametrize("name, want", [("03_iron-door_v2_7.png", "Iron Door"), ("USA flag (3).jpg", "USA Flag (3)"), ("a.b.png", "A.b"), ("12.castle_2024.png", "Castle 2024"), ("map.txt", "Map.txt"), ("7 - Old  well_12.PNG", "Old Well")])
def test_file_description(spark, name, want):
    assert one(spark, T.file_description(F.col("t")), t=s(name)) == want


def test_small_texts(spark):
    assert one(spark, T.title_words(F.col("t")), t=s("iron USA door")) == "Iron USA Door"
    assert one(spark, T.quoted(F.col("t")), t=s('a "b" \\ c')) == '"a \\"b\\" \\\\ c"' and one(spark, T.quoted(F.col("t")), t=s(None)) == "null"
    assert one(spark, T.place_spec(F.col("t")), t=s("door:10,-4,32")).asDict() == {"name": "door", "x": 10, "y": -4, "size": 32}
    assert one(spark, T.place_spec(F.col("t")), t=s("door:x")) is None
    assert one(spark, T.rgba(F.lit("#7A1212"), F.lit(0.30)), t=s("")).asDict() == {"r": 122, "g": 18, "b": 18, "a": 76}
    many = [f"tag-{i}" for i in range(40)]
    assert one(spark, T.tag_list(F.col("t")), t=s("Red Door, red-door;Blue\n," + "y" * 33 + "," + "z" * 32 + "," + ",".join(many))) == ["red-door", "blue", "z" * 32, *many]
    assert one(spark, T.distinct_ignoring_case(F.col("t")), t=("array<string>", ["Ab", "cd", "aB ", "CD", "e"])) == ["Ab", "cd", "e"]
    assert one(spark, T.first_match(F.col("t"), [("cruiser", "c"), ("light.?cruiser", "l")]), t=s("light cruiser")) == "c"


@pytest.mark.parametrize("spec, want", [
    ("deck1=ramp:north", (1, "ramp", "north")), ("deck12 = ramp : east", (12, "ramp", "east")), ("deck1=stairs:north", None), ("deck1=ramp:up", None), ("roof=ramp:north", None), ("deck=ramp:north", None), ("deck1=ramp", None), ("deck1:ramp=north", None),
])
def test_side_spec(spark, spec, want):
    got = one(spark, T.side_spec(F.col("t"), ("ramp", "windscreen"), ("north", "east")), t=s(spec))
    assert (got and tuple(got)) == want


@pytest.mark.parametrize("spec, want", [
    ("seal:wall", ("seal", "wall", "medium", None)), ("seal:wall,large", ("seal", "wall", "large", None)), ("seal: wall , large,, stone,more", ("seal", "wall", "large", "stone")), ("seal:wall,64", None), ("seal:wall,large,silk", None), ("seal:", None), ("seal", None),
])
def test_anchor_spec(spark, spec, want):
    got = one(spark, T.anchor_spec(F.col("t"), ("small", "medium", "large"), ("brass", "stone")), t=s(spec))
    assert (got and tuple(got)) == want


@pytest.mark.parametrize("text", ["plain", "two words", "a, b", "x: y", "it's", "50%", "tail ", " head", "null", "True", "falsey", "#1", "", "a-b_c.d", "é", "back\\slash", "back\\ and: more"])
def test_scalars_are_quoted_where_yaml_needs_it(spark, text):
    import yaml

    got = one(spark, T.quoted(F.col("t")), t=s(text))
    special = set(":#'\"\n[]{},&*?|>!%@`")
    needed = bool(set(text) & special) or text.lower() in ("null", "true", "false") or text.strip() != text
    assert got.startswith('"') == needed
    assert text == "" or yaml.safe_load(got) == text
    assert text == "" or yaml.safe_load(one(spark, T.quoted_list(F.col("t")), t=("array<string>", [text, "x"]))) == [text, "x"]


@pytest.mark.parametrize("payload, want", [
    ('{"text": "a"}', "a"), ('{"caption": "b", "x": 1}', "b"), ('["c", "d"]', "c d"), ('[{"text": "e"}, ["f", [{"value": {"string": " g "}}]]]', "e f g"), ('"h"', "h"), ("not json", None), ('{"result": 5, "caption": "no"}', "5"), ('{"string": true}', "True"),
    ('{"text": null, "caption": "no"}', None), ('{"caption": "no", "value": []}', None), ("{}", None), ("null", None), ("[]", None), ("", None), (None, None), ('{"x": "y"}', None), ("[" * 100_000, None), ("[" * 200 + '"deep"' + "]" * 200, "deep"),
])
def test_payload(spark, payload, want):
    assert one(spark, T.payload_text(F.col("t")), t=s(payload)) == want


@pytest.mark.parametrize("name, state, orientation, want", [("Wooden Bed", "damaged", "north", "Wooden Bed — damaged, north"), ("Brass Lamp", "active", "isometric", "Brass Lamp — active, isometric"), ("Damaged Bed", "damaged", None, "Damaged Bed"), (None, None, "north", "stem — north")])
def test_display_name(spark, name, state, orientation, want):
    assert one(spark, T.display_name(F.col("n"), F.lit("stem"), F.col("st"), F.col("o")), n=s(name), st=s(state), o=s(orientation)) == want


def test_preset_tags(spark):
    got = one(spark, T.preset_tags(F.col("t"), F.lit("north"), F.lit("damaged"), F.lit("1111")), t=("array<string>", ["furniture", "bed", "bed"]))
    assert got == ["furniture", "bed", "facing-north", "state-damaged", "group:1111"]


def test_training_caption_leaves_out_long_descriptions(spark):
    c = lambda d: one(spark, T.training_caption(F.lit("tok"), F.lit("Bed"), F.lit(None).cast("string"), F.lit("intact"), F.array(*[F.lit(str(i)) for i in range(9)]), F.col("d")), d=s(d))
    assert c("soft") == "tok, Bed, intact, 0, 1, 2, 3, 4, 5, 6, 7, soft" and c("x" * 240) == c("") == c(None) == "tok, Bed, intact, 0, 1, 2, 3, 4, 5, 6, 7"


def test_identifiers(spark):
    ns = uuid.UUID("6ba7b810-9dad-11d1-80b4-00c04fd430c8")
    for name in ("bed:abc", "é", "", "x" * 99):
        assert one(spark, H.uuid5(str(ns), F.col("t")), t=s(name)) == str(uuid.uuid5(ns, name))
    digest = lambda a: one(spark, H.member_digest(F.col("a")), a=("array<string>", a))
    assert digest(["b", "a"]) == digest(["a", "b"]) != digest(["a"])
    assert one(spark, H.near_hash(F.lit(0b1011), F.lit(0b0001)), t=s("")) is True


def test_vectors(spark):
    a = ("array<float>", [3.0, 4.0])
    assert one(spark, V.norm(F.col("a")), a=a) == 5.0
    assert one(spark, V.cosine(F.col("a"), F.array(F.lit(0.0), F.lit(0.0))), a=a) == 0.0
    assert one(spark, V.normalized(F.col("a")), a=a) == [0.6, 0.8]
    p = one(spark, V.softmax(F.col("a"), 1.0), a=a)
    assert abs(sum(p) - 1) < 1e-12 and p[1] > p[0]
    assert one(spark, V.upper_median(F.col("a")), a=("array<double>", [1.0, 2.0, 3.0, 4.0])) == 3.0
    assert abs(one(spark, V.top_two(F.col("a")), a=("array<double>", [0.1, 0.7, 0.4])).margin - 0.3) < 1e-12


def test_geometry(spark):
    assert one(spark, G.rgb_of_argb(F.lit("ffffd9a0")), t=s("")) == "ffd9a0"
    assert one(spark, G.to_pixels(F.lit(3.456), F.lit(0.0), F.lit(100)), t=s("")) == 345.6
    assert one(spark, G.square_crop(F.lit(5), F.lit(95), F.lit(40), F.lit(100), F.lit(100)), t=s("")).asDict() == {"x": 0, "y": 60, "side": 40}
    assert one(spark, G.anchored_box(F.lit(0.5), F.lit(0.5), F.lit(200), F.lit(100), F.lit(10), F.lit(1.0)), t=s("")).asDict() == {"x": 68, "y": 18, "side": 64}
    points = one(spark, G.around(F.lit(0), F.lit(0), F.lit(10), F.lit(10), F.lit(4)), t=s(""))
    assert [(p.x, p.y) for p in points] == [(0, 0), (10, 0), (10, 10), (0, 10)]
    assert one(spark, G.spaced(F.lit(2), F.lit(0.0), F.lit(8.0)), t=s("")) == [2.0, 6.0]
    for w, h in ((128, 128), (100, 333), (2000, 1500), (1023, 1999), (7, 9), (1024, 1031)):
        scale = 1024 / min(w, h)
        grown = [max(1024, round(x * scale)) for x in (w, h)] if min(w, h) < 1024 else [w, h]
        assert tuple(one(spark, G.latent_size(F.lit(w), F.lit(h), 1024), t=s(""))) == tuple(x // 8 * 8 for x in grown)
    for c, r in ((0, 0), (1, 0), (-1, -1), (-2, 3), (5, 2)):
        got = one(spark, G.hex_centre(F.lit(c), F.lit(r), 10.0), t=s(""))
        down = 3**0.5 * 10
        assert (got.x, got.q, got.r) == (c * 15.0, c, r - (c - (c & 1)) // 2) and abs(got.y - (r * down + (down / 2 if c % 2 else 0))) < 1e-9
    head = one(spark, G.arrow_head(F.lit(0.0), F.lit(0.0), F.lit(10.0), F.lit(0.0), 2.0), t=s(""))
    assert head.middle.x == 5.0 and head.left.x < 10 and abs(head.left.y + head.right.y) < 1e-12


@pytest.mark.parametrize("name, want", [(None, ("null", None)), ("  ", ("null", None)), ("Square", ("nullify", "exact_generic")), ("Bowl. The image is", ("nullify", "leak")), ("chair", ("nullify", "single_lowercase")), ("Wooden Bed", ("keep", None)), ('"square"', ("nullify", "exact_generic")), ("x1", ("nullify", "single_lowercase")), ("tank-top", ("nullify", "single_lowercase")), ("été", ("nullify", "single_lowercase")), ("Chair", ("keep", None))])
def test_name_verdict(spark, name, want):
    assert tuple(one(spark, verdicts.name_verdict(F.col("t"), ["square"], [("leak", r"\bThe image\b")]), t=s(name))) == want


def test_size_gates(spark):
    g = lambda w, h, longer: one(spark, verdicts.gate(F.lit("CC0"), F.col("w"), F.col("h"), F.lit("png"), F.lit(False), ["cc0"], ["png"], 1024, longer), w=("int", w), h=("int", h))
    assert [g(2000, 500, False), g(2000, 500, True), g(1024, 1024, False), g(1000, 900, True), g(None, None, True)] == ["size", "ok", "ok", "size", "size"]


def test_policies(spark):
    assert one(spark, verdicts.policy_breach(F.lit(45), F.lit(False), F.array(F.lit(0), F.lit(90)), F.lit(True)), t=s("")) == "rotation"
    assert one(spark, verdicts.terms_match(F.array(F.lit("Red")), F.lit("door"), ["DOOR"]), t=s("")) is True
    assert one(spark, verdicts.must(F.col("t") == "a", "not a"), t=s("a")) is True
    with pytest.raises(Exception, match="not a"):
        one(spark, verdicts.must(F.col("t") == "a", "not a"), t=s("b"))
    rows = spark.createDataFrame([("a", "", 100.5), (None, "x", 100.0)], "id string, name string, size double")
    checks = [("error", "id", F.col("id").isNull()), ("error", "name", F.col("name") == ""), ("warning", "size", F.col("size") % 1 > 0)]
    assert sorted(map(tuple, verdicts.violations(rows, F.col("id"), checks).collect()), key=str) == [("a", "error", "name"), ("a", "warning", "size"), (None, "error", "id")]


@pytest.mark.parametrize("damage, margin, activation, other, want", [
    ("intact", 0.3, "active", 0.9, ("active", "activation=active (margin 0.90, beats damage intact/0.30)")), ("stateless", 0.3, "inactive", 0.5, ("inactive", "activation=inactive (margin 0.50, beats damage stateless/0.30)")),
    ("damaged", 0.3, "active", 0.9, ("damaged", "damage=damaged (margin 0.30)")), ("intact", 0.6, "active", 0.5, ("intact", "damage=intact (margin 0.60)")), ("intact", 0.3, "active", 0.4, ("intact", "damage=intact (margin 0.30)")),
    ("intact", 0.1, "no device", 0.9, (None, "damage margin too low (0.10)")), ("stateless", 0.3, "no device", 0.9, (None, "stateless object (margin 0.30)")), ("melted", 0.3, "active", 0.9, (None, "unknown damage label 'melted'")),
])
def test_state_decision(spark, damage, margin, activation, other, want):
    decided = verdicts.state_decision(F.col("d"), F.col("m"), F.col("a"), F.col("o"), 0.2, 0.5)
    assert tuple(one(spark, decided, d=s(damage), m=("double", margin), a=s(activation), o=("double", other))) == want


def test_zone_block(spark):
    sections = [("all_full", ("all_left", "all_right")), ("end_full", ("end_left",))]
    zones = F.create_map(*[F.lit(x) for x in ("all_right", "a door", "end_full", "stairs", "end_left", "nothing")])
    at = F.create_map(F.lit("all_right"), F.lit("right half"))
    assert one(spark, T.zone_block(zones, sections, at), t=s("")) == "  - all_right (right half): a door.\n  - end_full (end_full): stairs."
