"""Data quality: differences between two sources, invalid and blank values, url health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions.text import blank_fill, encode_url, is_blank, norm
from skuloom.operators.eav import attribute_rows, value_rows
from skuloom.operators.joins import lookup_join
from skuloom.session import materialise
from skuloom.sources.tables import append_evolving, overwrite_table

LEFT, RIGHT = "site", "catalogo"


def shared_columns(left: DataFrame, right: DataFrame, key: str) -> list[str]:
    """Columns of the right table that the left one has too, without the key."""
    return [c for c in right.columns if c in left.columns and c != key]


def _paired(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys found on both sides with both rows as structs ``e`` and ``d``."""

    def side(df: DataFrame, name: str) -> DataFrame:
        values = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
        return df.select(F.trim(F.col(key).cast("string")).alias(key), values.alias(name))

    return side(left, "e").join(side(right, "d"), key)


def _differs(column: str) -> Column:
    return ~norm(F.col("e")[column]).eqNullSafe(norm(F.col("d")[column]))


def column_diff(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key and column whose trimmed, lower-cased values differ.

    All columns are compared in one join; null equals only null.
    """
    checks = F.array(
        *[
            F.struct(
                F.lit(c).alias("coluna"),
                F.trim(F.col("e")[c]).alias(f"valor_{LEFT}"),
                F.trim(F.col("d")[c]).alias(f"valor_{RIGHT}"),
                _differs(c).alias("difere"),
            )
            for c in columns
        ]
    )
    found = F.filter(checks, lambda check: check["difere"])
    return _paired(left, right, key, columns).select(key, F.inline(found)).drop("difere")


def diff_matrix(
    left: DataFrame,
    right: DataFrame,
    key: str,
    columns: list[str],
    prefixes: tuple[str, str] = (LEFT, RIGHT),
    drop_equal: bool = False,
) -> DataFrame:
    """One row per common key: both values of each differing column, blank where they agree.

    Both values are on the joined row already, so the matrix needs no pivot. With ``drop_equal``
    columns that never differ are left out: the joined rows are written once to the shared
    folder, and one aggregated row of flags decides the schema.
    """
    paired = _paired(left, right, key, columns)
    if drop_equal:
        paired = materialise(paired)
        flags = paired.agg(*[F.bool_or(_differs(c)).alias(c) for c in columns]).first()
        columns = [c for c in columns if flags[c]]
    pairs = []
    for c in columns:
        for prefix, side in zip(prefixes, ("e", "d")):
            pairs.append(F.when(_differs(c), F.col(side)[c]).alias(f"{prefix}_{c}"))
    return blank_fill(paired.select(key, *pairs)).distinct()


def side_by_side(
    left: DataFrame,
    right: DataFrame,
    key: str,
    columns: list[str],
    prefixes: tuple[str, str] = (LEFT, RIGHT),
) -> DataFrame:
    """Both values of each column and whether they agree, null counting as blank."""

    def text(column: Column) -> Column:
        return norm(F.coalesce(column, F.lit("")))

    selected = [F.col(key)]
    for c in columns:
        e, d = F.col("e")[c], F.col("d")[c]
        selected += [
            e.alias(f"{prefixes[0]}_{c}"),
            d.alias(f"{prefixes[1]}_{c}"),
            (text(e) == text(d)).alias(f"validar_{c}"),
        ]
    return _paired(left, right, key, columns).select(*selected)


def _with_id(df: DataFrame) -> DataFrame:
    return df.withColumn("id_atributo_entrada", norm(F.col("id")))


def invalid_numbers(products: DataFrame, number_ids: DataFrame) -> DataFrame:
    """Values of numeric attributes that are no whole number of ten digits, nulls included."""
    numeric = lookup_join(
        _with_id(attribute_rows(products)), number_ids, ["id_atributo_entrada"], "left_semi"
    )
    return (
        numeric.select("brand", "sku", "id_atributo_entrada", F.inline("values"))
        .where(F.col("value").try_cast("decimal(10,0)").isNull())
        .select("brand", "sku", "id_atributo_entrada", F.col("value").alias("valor"))
        .distinct()
    )


FINDING = ["regra", "origem", "marca", "sku", "id", "valor"]
BLANK_NAME, BLANK_URL, INVALID_NUMBER = "nome_vazio", "url_vazia", "numero_invalido"


def attribute_name_findings(products: DataFrame, record_ids: DataFrame) -> DataFrame:
    """Attributes without a name, once per brand and id."""
    known = lookup_join(
        _with_id(attribute_rows(products)), record_ids, ["id_atributo_entrada"], "left_semi"
    )
    return (
        known.where(is_blank(F.col("name")))
        .select(
            F.lit(BLANK_NAME).alias("regra"),
            F.lit("golden_record.attributes").alias("origem"),
            F.col("brand").alias("marca"),
            F.lit(None).cast("string").alias("sku"),
            F.col("id_atributo_entrada").alias("id"),
            F.col("name").alias("valor"),
        )
        .distinct()
    )


def asset_findings(products: DataFrame, kind: str) -> DataFrame:
    """Blank asset names, asset attribute names and asset urls in one pass over ``assets.<kind>``.

    A blank url counts even without a brand, a null url only with one.
    """
    origin = f"golden_record.{kind}"
    assets = products.select("sku", "brand", F.inline(f"assets.{kind}"))

    def finding(rule: str, place: str, identifier: Column, value: Column) -> Column:
        texts = [F.lit(rule), F.lit(place), F.col("brand"), F.col("sku"), norm(identifier), value]
        return F.struct(*[t.alias(n) for t, n in zip(texts, FINDING)])

    no_url = (F.col("brand").isNotNull() & F.col("url").isNull()) | (F.trim("url") == "")
    own = F.array_compact(
        F.array(
            F.when(is_blank(F.col("name")), finding(BLANK_NAME, origin, F.col("id"), F.col("name"))),
            F.when(no_url, finding(BLANK_URL, origin, F.col("id"), F.col("url"))),
        )
    )
    nameless = F.filter("attributes", lambda a: is_blank(a["name"]))
    nested = F.transform(
        F.coalesce(nameless, F.array()),
        lambda a: finding(BLANK_NAME, f"{origin}.attributes", a["id"], a["name"]),
    )
    return assets.select(F.inline(F.concat(own, nested)))


def blank_names(
    products: DataFrame, record_ids: DataFrame, documents: DataFrame, images: DataFrame
) -> DataFrame:
    """Missing names in all five places."""
    assets = asset_findings(documents, "documents").unionByName(asset_findings(images, "images"))
    return attribute_name_findings(products, record_ids).unionByName(
        assets.where(F.col("regra") == BLANK_NAME)
    )


def blank_urls(documents: DataFrame, images: DataFrame) -> DataFrame:
    """Missing urls of documents (distinct) and images (every occurrence)."""
    named = asset_findings(documents, "documents").where(F.col("regra") == BLANK_URL).distinct()
    return named.unionByName(asset_findings(images, "images").where(F.col("regra") == BLANK_URL))


def attribute_findings(
    products: DataFrame, record_ids: DataFrame, number_ids: DataFrame
) -> DataFrame:
    """Nameless attributes and invalid numbers in one pass over the attributes."""
    record = record_ids.withColumns({"_nome": F.lit(True), "_numero": F.lit(False)})
    number = number_ids.withColumns({"_nome": F.lit(False), "_numero": F.lit(True)})
    rules = record.unionByName(number).groupBy("id_atributo_entrada").agg(
        F.bool_or("_nome").alias("_nome"), F.bool_or("_numero").alias("_numero")
    )
    checked = lookup_join(
        _with_id(attribute_rows(products)), rules, ["id_atributo_entrada"], "inner"
    )

    def finding(rule: str, sku: Column, value: Column) -> Column:
        place, identifier = F.lit("golden_record.attributes"), F.col("id_atributo_entrada")
        texts = [F.lit(rule), place, F.col("brand"), sku, identifier, value]
        return F.struct(*[t.alias(n) for t, n in zip(texts, FINDING)])

    nowhere = F.lit(None).cast("string")
    nameless = F.when(
        F.col("_nome") & is_blank(F.col("name")), F.array(finding(BLANK_NAME, nowhere, F.col("name")))
    )
    invalid = F.filter(
        "values", lambda v: F.col("_numero") & v["value"].try_cast("decimal(10,0)").isNull()
    )
    numbers = F.transform(invalid, lambda v: finding(INVALID_NUMBER, F.col("sku"), v["value"]))
    both = F.concat(F.coalesce(nameless, F.array()), F.coalesce(numbers, F.array()))
    return checked.select(F.inline(both)).distinct()


def findings(
    products: DataFrame,
    record_ids: DataFrame,
    number_ids: DataFrame,
    documents: DataFrame,
    images: DataFrame,
) -> DataFrame:
    """All findings of all rules; each of the three sources is read once."""
    return (
        attribute_findings(products, record_ids, number_ids)
        .unionByName(asset_findings(documents, "documents"))
        .unionByName(asset_findings(images, "images"))
    )


def asset_urls(products: DataFrame, kind: str) -> DataFrame:
    """(origin, sku, url) of the assets of branded products."""
    return (
        products.where(F.col("brand").isNotNull())
        .select("sku", F.inline(f"assets.{kind}"))
        .select(F.lit(f"golden_record.{kind}").alias("origem"), "sku", F.trim("url").alias("url"))
    )


def url_targets(
    documents: DataFrame, images: DataFrame, products: DataFrame, url: str, prefix: str | None = None
) -> DataFrame:
    """Distinct (origin, sku, url) of documents, images and product pages.

    With ``prefix`` the product column holds a path, which is encoded and put after it.
    """
    address = F.trim(url)
    if prefix is not None:
        address = F.concat(F.lit(prefix), encode_url(address))
    pages = products.where(F.col(url).isNotNull()).select(
        F.lit("produto").alias("origem"), "sku", address.alias("url")
    )
    return (
        asset_urls(documents, "documents")
        .unionByName(asset_urls(images, "images"))
        .unionByName(pages)
        .distinct()
    )


def crawl_verdict(phrase: str = K.NOT_FOUND_PHRASE) -> Column:
    """Why a crawl result is bad; null for a good one."""
    status = F.col("status")
    return (
        F.when(status > 200, F.lit("erro_http"))
        .when(status == -1, F.lit("sem_resposta"))
        .when((status == 200) & F.contains("body", F.lit(phrase)), F.lit("pagina_inexistente"))
    )


def url_health(
    targets: DataFrame, crawl: DataFrame, phrase: str = K.NOT_FOUND_PHRASE
) -> DataFrame:
    """Targets whose crawl result is bad.

    Results are judged before the join, so page bodies never enter a shuffle; one url may be
    used by a large share of the targets, so the bad ones are joined as a spread lookup.
    """
    bad = (
        crawl.select(F.trim("url").alias("url"), "status", crawl_verdict(phrase).alias("situacao"))
        .where(F.col("situacao").isNotNull())
        .distinct()
    )
    return lookup_join(targets, bad, ["url"], "inner").select("origem", "sku", "url", "status", "situacao")


URL_STATE = ["status", "situacao"]


def url_verdicts(crawl: DataFrame, load_time: Column, phrase: str = K.NOT_FOUND_PHRASE) -> DataFrame:
    """One verdict per url of a crawl, good ones too (no ``situacao``), with the time of the load.

    Bodies are judged before the shuffle. Of several results for a url the largest status counts.
    """
    judged = crawl.select(
        F.trim("url").alias("url"), F.struct("status", crawl_verdict(phrase).alias("situacao")).alias("estado")
    )
    worst = judged.where(F.col("url").isNotNull()).groupBy("url").agg(F.max("estado").alias("estado"))
    return worst.select("url", "estado.*", load_time.alias("data_ingestao"))


def append_url_log(crawl: DataFrame, path: str, load_time: Column, phrase: str = K.NOT_FOUND_PHRASE) -> str:
    """Append the verdicts of a crawl to the log; what was logged before stays."""
    return append_evolving(url_verdicts(crawl, load_time, phrase), path)


def latest_urls(log: DataFrame) -> DataFrame:
    """The newest verdict of every url; of several from one time the largest."""
    newest = log.groupBy("url").agg(F.max(F.struct("data_ingestao", *URL_STATE)).alias("ultimo"))
    return newest.select("url", "ultimo.*").select("url", *URL_STATE, "data_ingestao")


def due_urls(targets: DataFrame, log: DataFrame, before: Column) -> DataFrame:
    """Distinct target urls that were never judged, or last judged before a time.

    Both sides are reduced to one row per url before they meet, so no url is hot.
    """
    urls = targets.select(F.trim("url").alias("url")).where(F.col("url") != "").distinct()
    recent = latest_urls(log).where(F.col("data_ingestao") >= before)
    return urls.join(recent.select("url"), "url", "left_anti")


def compact_urls(log: DataFrame, path: str) -> str:
    """Write the newest verdicts as a new log, see ``latest_urls``; the old one may go afterwards."""
    return overwrite_table(latest_urls(log), path)
