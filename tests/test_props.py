from catalog_sync.operators import props as pr

# Fixed test data: the three real property strings of the reference's parsing check.
GOLDEN = [
    "Бренд: Lemark | Материал: Латунь | Цвет: Хром | Гарантия: 4 года | Страна: Китай | Тип смесителя: Двухручковый | Серия: Серия Neo | Тип установки: На стену | Материал ручки: Металл | Товарная категория: Смесители для ванны | Вид лейки: 1-функциональная | Вид дивертора: Переключатель с керамическими пластинами | Тип излива: Поворотный | Город: Jesenice U Prahy Czech republic | ИзображениеМарки: Lemark | С донным клапаном (Смесители): Нет | Сенсорный (Смесители): Нет | С хирургической ручкой (Смесители): Нет | Тип корпуса: Поворотный | Стандарт подводки шланга (Смесители): 1/2\" | Термостатический (Смесители): Нет | Наличие душевого гарнитура: Есть | Отверстие для смесителя: 2 | Для раковины-чаши: Нет | Тип длины излива: Длинный | Крепление лейки: На стену",
    "| Материал: Латунь | Цвет: Хром | Гарантия: 4 года | Страна: Китай | Тип смесителя: Двухручковый | Серия: Серия Neo | Тип установки: На стену | Материал ручки: Металл | Товарная категория: Смесители для ванны | Вид лейки: 1-функциональная | Вид дивертора: Переключатель с керамическими пластинами | Тип излива: Поворотный | Город: Jesenice U Prahy Czech republic | ИзображениеМарки: Lemark | С донным клапаном (Смесители): Нет | Сенсорный (Смесители): Нет | С хирургической ручкой (Смесители): Нет | Тип корпуса: Поворотный | Стандарт подводки шланга (Смесители): 1/2\" | Термостатический (Смесители): Нет | Наличие душевого гарнитура: Есть | Отверстие для смесителя: 2 | Для раковины-чаши: Нет | Тип длины излива: Длинный | Крепление лейки: На стену",
    "| Вид аэратора: Стандартный | Тип смесителя: Двухручковый | Серия: Серия Neo | Тип установки: На стену | Материал ручки: Металл | Товарная категория: Смесители для ванны | Вид лейки: 1-функциональная | Вид дивертора: Переключатель с керамическими пластинами | Тип излива: Поворотный | Город: Jesenice U Prahy Czech republic | ИзображениеМарки: Lemark | С донным клапаном (Смесители): Нет | Сенсорный (Смесители): Нет | С хирургической ручкой (Смесители): Нет | Тип корпуса: Поворотный | Стандарт подводки шланга (Смесители): 1/2\" | Термостатический (Смесители): Нет | Наличие душевого гарнитура: Есть | Отверстие для смесителя: 2 | Для раковины-чаши: Нет | Тип длины излива: Длинный | Крепление лейки: На стену",
]


def parse(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, product_properties string")
    out = {}
    for r in pr.parse_properties(df).collect():
        out.setdefault(r["product_id"], {})[r["prop_key"]] = r["prop_value"]
    return out


def test_golden_counts_and_clean_keys(spark):
    got = parse(spark, GOLDEN)
    assert [len(got[i]) for i in range(3)] == [26, 25, 22]
    assert not any("|" in k for d in got.values() for k in d)
    assert got[0]["Стандарт подводки шланга (Смесители)"] == '1/2"'
    assert got[1]["Материал"] == "Латунь"


def test_edge_cases(spark):
    got = parse(spark, [
        "| a: 1 | junk | b: x: y |  c :  3  ",
        "k: 1 | k: 2 | e: | : v",
        "",
    ])
    assert got[0] == {"a": "1", "b": "x: y", "c": "3"}
    assert got[1] == {"k": "2"}
    assert 2 not in got


def test_repair_and_search(spark):
    props = spark.createDataFrame(
        [(1, "| Color", "black", None), (1, "Color", "white", None), (2, "Brand", "H", None), (2, "Color", "black", None),
         (3, "Color", "black", None)],
        "product_id long, prop_key string, prop_value string, updated_at timestamp_ntz",
    )
    fixed, stats = pr.repair_property_keys(props, "2024-06-01 00:00:00")
    got = {(r["product_id"], r["prop_key"]): r["prop_value"] for r in fixed.collect()}
    assert got[(1, "Color")] == "black" and len(got) == 4
    s = stats.first()
    assert (s["found"], s["fixed"], s["remaining"]) == (1, 1, 0)
    products = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    f = {"Color": "black", "Brand": "H"}
    for method in ("having", "selfjoin"):
        assert [r[0] for r in pr.search_by_properties(products, fixed, f, method=method).collect()] == [2]
    assert sorted(r[0] for r in pr.search_by_properties(products, fixed, {"Color": "black"}, method="single").collect()) == [1, 2, 3]


def test_property_map_and_sync(spark):
    old = spark.createDataFrame([(1, "a", "1", None), (1, "b", "2", None), (2, "a", "9", None)],
                                "product_id long, prop_key string, prop_value string, updated_at timestamp_ntz")
    snap = spark.createDataFrame([(1, "a: 1 | c: 3")], "id long, product_properties string")
    out = pr.sync_properties(old, snap, "2024-06-01 00:00:00")
    got = {(r["product_id"], r["prop_key"]): r["prop_value"] for r in out.collect()}
    assert got == {(1, "a"): "1", (1, "c"): "3", (2, "a"): "9"}
    m = {r["product_id"]: r["properties"] for r in pr.property_map(out.drop("updated_at")).collect()}
    assert m[1] == {"a": "1", "c": "3"}


def _reference_reading(text):
    """The documented pattern read with Python's re: strip() both groups, drop empties, last key wins."""
    import re

    out = {}
    for m in re.finditer(pr.PROPERTY_PATTERN, text):
        k, v = m.group(1).strip(), m.group(2).strip()
        if k and v:
            out[k] = v
    return out


def test_parser_agrees_with_the_documented_pattern_on_random_text(spark):
    import random

    rng = random.Random(7)
    alphabet = ["a", "b", "K", "é", "Ц", "1", " ", " ", ":", ":", "|", "|", "\n", "\t", "\r", "\xa0", "\u3000", '"', "("]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    got = parse(spark, texts)
    for i, t in enumerate(texts):
        assert got.get(i, {}) == _reference_reading(t), repr(t)
