"""JSON documents of the catalog service, read with fixed schemas and written back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CREDIT = "struct<name:string,joinphrase:string,artist:struct<id:string,name:string,`sort-name`:string>>"
TAG = "struct<name:string,count:int>"
RELEASE_GROUP = f"struct<id:string,title:string,`primary-type`:string,`secondary-types`:array<string>,`first-release-date`:string,tags:array<{TAG}>>"
LABEL_INFO = "struct<`catalog-number`:string,label:struct<id:string,name:string,type:string>>"
RELEASE = (
    f"struct<id:string,title:string,status:string,date:string,country:string,packaging:string,barcode:string,`artist-credit`:array<{CREDIT}>,"
    f"`release-group`:{RELEASE_GROUP},`label-info`:array<{LABEL_INFO}>,tags:array<{TAG}>>"
)
RECORDING = (
    f"struct<id:string,title:string,score:int,length:bigint,disambiguation:string,`first-release-date`:string,isrcs:array<string>,"
    f"`artist-credit`:array<{CREDIT}>,releases:array<{RELEASE}>,tags:array<{TAG}>,genres:array<{TAG}>>"
)
ARTIST = (
    f"struct<id:string,name:string,`sort-name`:string,score:int,aliases:array<struct<name:string,`sort-name`:string>>,tags:array<{TAG}>,"
    "relations:array<struct<type:string,`target-type`:string,url:struct<resource:string>>>>"
)
IMAGES = "struct<release:string,images:array<struct<id:bigint,front:boolean,back:boolean,approved:boolean,image:string,types:array<string>>>>"


def _underscored(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name.replace("-", "_"), _underscored(f.dataType), f.nullable) for f in kind.fields])
    return T.ArrayType(_underscored(kind.elementType)) if isinstance(kind, T.ArrayType) else kind


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per JSON file; keys with dashes come out with underscores."""
    kind = T.DataType.fromDDL(schema)
    raw = spark.read.schema(kind).json(path, multiLine=True)
    return raw.select(*(F.col(f"`{f.name}`").cast(_underscored(f.dataType)).alias(f.name.replace("-", "_")) for f in kind.fields))


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON file, the whole document as the VARIANT ``doc`` (see ``functions.variants``); a file that is no JSON fails."""
    return spark.read.format("json").option("singleVariantColumn", "doc").option("multiLine", True).option("mode", "FAILFAST").load(path)


def write_documents(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def json_object(text: Column, status: Column) -> Column:
    """struct(ok, error): whether a response is a success whose body is a JSON object."""
    parsed = F.try_parse_json(text)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    error = F.when(status != 200, F.concat(F.lit("status "), status.cast("string"))).when(parsed.isNull(), F.lit("not json")).when(~is_object, F.lit("not an object"))
    return F.struct(error.isNull().alias("ok"), error.alias("error"))


def image_path(entity: Column, uuid: Column, size: Column) -> Column:
    return F.concat(F.lit("/"), entity, F.lit("/"), uuid, F.lit("/front-"), F.coalesce(size, F.lit("500")))


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """Cover images that were fetched into a folder, as binary rows."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length", "content")
