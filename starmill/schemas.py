"""Declared tables: operational source, warehouse and external catalogue.

Surrogate keys are bigint. Parquet tables enforce neither keys nor NOT NULL, so
``starmill.operators.quality`` reads the constraints from these declarations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "text": T.StringType(),
}
_SQL = {"int": "INT", "long": "BIGINT", "double": "DOUBLE", "date": "DATE", "text": "STRING"}


@dataclass(frozen=True)
class Column:
    name: str
    kind: str
    length: int | None = None
    nullable: bool = False


@dataclass(frozen=True)
class Table:
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[tuple[str, str], ...] = ()  # (column, parent table)

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, _TYPES[c.kind], c.nullable) for c in self.columns])

    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def required(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    def lengths(self) -> dict[str, int]:
        return {c.name: c.length for c in self.columns if c.length}

    def ddl(self) -> str:
        return ", ".join(
            f"{c.name} {f'VARCHAR({c.length})' if c.length else _SQL[c.kind]}"
            f"{'' if c.nullable else ' NOT NULL'}"
            for c in self.columns
        )


def _table(columns: dict[str, str | tuple], key: str = "", parents: dict[str, str] | None = None) -> Table:
    built = []
    for name, kind in columns.items():
        if isinstance(kind, int):
            built.append(Column(name, "text", kind))
        else:
            built.append(Column(name, kind.rstrip("?"), None, kind.endswith("?")))
    return Table(tuple(built), tuple(key.split()), tuple((parents or {}).items()))


# ---------------------------------------------------------------------------
# Names, types, lengths and keys of the operational source.
# A number is a VARCHAR length; '?' marks a nullable column.
# ---------------------------------------------------------------------------
OPERATIONAL: dict[str, Table] = {
    "plano": _table({"planoid": "int", "precomensal": "double", "planonome": 128}, "planoid"),
    "assinatura": _table(
        {"assinaturaid": "int", "datainicio": "date", "datafim": "date", "status": "int", "planoid": "int"},
        "assinaturaid",
        {"planoid": "plano"},
    ),
    "usuario": _table(
        {
            "usuarioid": "int", "email": 128, "telefone": 128, "datavencimento": "date",
            "codigode_seguranca": "int", "numerodo_cartao": 128, "nomedo_proprietario": 128,
            "senha": "int", "usuarionome": 128, "bairro": 128, "municipio": 128, "estado": 128,
            "logradouro": 128,
        },
        "usuarioid",
    ),
    "filme": _table(
        {"duracaomin": "int", "filmenome": 128, "filmeid": "int", "anode_lancamento": "int"}, "filmeid"
    ),
    "avaliacao": Table(
        (
            Column("comentario", "text", 255, True),
            Column("avaliacaodata", "date"),
            Column("nota", "int"),
            Column("avaliacaoid", "int"),
            Column("usuarioid", "int"),
            Column("filmeid", "int"),
        ),
        ("avaliacaoid",),
        (("usuarioid", "usuario"), ("filmeid", "filme")),
    ),
    "produtora": _table({"produtoraid": "int", "produtoranome": 128}, "produtoraid"),
    "cargo": _table({"cargoid": "int", "cargonome": 128}, "cargoid"),
    "funcionario": _table(
        {"funcionarioid": "int", "salario": "double", "funcionarionome": 128, "cargoid": "int"},
        "funcionarioid",
        {"cargoid": "cargo"},
    ),
    "usrpagto": _table(
        {
            "usrpagtoid": "int", "valorpago": "double", "datapagto": "date", "usuarioid": "int",
            "assinaturaid": "int",
        },
        "usrpagtoid",
        {"usuarioid": "usuario", "assinaturaid": "assinatura"},
    ),
    "assiste": _table(
        {"data": "date", "usuarioid": "int", "filmeid": "int"},
        "usuarioid filmeid",
        {"usuarioid": "usuario", "filmeid": "filme"},
    ),
    "modera": _table(
        {"funcionarioid": "int", "avaliacaoid": "int"},
        "funcionarioid avaliacaoid",
        {"funcionarioid": "funcionario", "avaliacaoid": "avaliacao"},
    ),
    "gerencia_conteudo": _table(
        {"filmeid": "int", "funcionarioid": "int"},
        "filmeid funcionarioid",
        {"filmeid": "filme", "funcionarioid": "funcionario"},
    ),
    "filmpagtoroy": _table(
        {"valorpagto": "double", "datapagto": "date", "produtoraid": "int", "filmeid": "int"},
        "produtoraid filmeid",
        {"produtoraid": "produtora", "filmeid": "filme"},
    ),
    "filme_generofilme": _table(
        {"generofilme": 128, "filmeid": "int"}, "generofilme filmeid", {"filmeid": "filme"}
    ),
    "filme_diretorfilme": _table(
        {"diretorfilme": 128, "filmeid": "int"}, "diretorfilme filmeid", {"filmeid": "filme"}
    ),
    "filme_atorfilme": _table({"atorfilme": 128, "filmeid": "int"}, "atorfilme filmeid", {"filmeid": "filme"}),
}

# ---------------------------------------------------------------------------
# Names, types, lengths and keys of the warehouse.
# ---------------------------------------------------------------------------
WAREHOUSE: dict[str, Table] = {
    "usuario": _table({"usuariosk": "long", "email": 128, "telefone": 64}, "usuariosk"),
    "filme": _table(
        {"filmesk": "long", "duracaomin": "int", "filmenome": 128, "anodelancamento": "int", "generonome": 128},
        "filmesk",
    ),
    "endereco": _table(
        {"enderecosk": "long", "bairro": 128, "municipio": 128, "estado": 64, "logradouro": 128}, "enderecosk"
    ),
    "calendario": _table(
        {
            "calendariosk": "long", "datacompleta": "date", "diasemana": 9, "dia": "int", "mes": "int",
            "trimestre": "int", "ano": "int",
        },
        "calendariosk",
    ),
    "produtora": _table({"produtorask": "long", "produtoranome": 128}, "produtorask"),
    "avaliacao": _table(
        {
            "avaliacaosk": "long", "nota": "int", "usuariosk": "long", "filmesk": "long",
            "produtorask": "long", "calendariosk": "long",
        },
        "avaliacaosk",
        {"usuariosk": "usuario", "filmesk": "filme", "produtorask": "produtora", "calendariosk": "calendario"},
    ),
    "receita": _table(
        {"receitask": "long", "valorpago": "double", "usuariosk": "long", "calendariosk": "long", "enderecosk": "long"},
        "receitask",
        {"usuariosk": "usuario", "calendariosk": "calendario", "enderecosk": "endereco"},
    ),
}

# After the address roll-up: one address row per state, the rating fact carries
# the address key, and the prediction fact exists.
ROLLED_UP: dict[str, Table] = {
    **WAREHOUSE,
    "endereco": _table({"enderecosk": "long", "estado": 64}, "enderecosk"),
    "avaliacao": _table(
        {
            "avaliacaosk": "long", "nota": "int", "usuariosk": "long", "filmesk": "long",
            "produtorask": "long", "calendariosk": "long", "enderecosk": "long?",
        },
        "avaliacaosk",
        {
            "usuariosk": "usuario", "filmesk": "filme", "produtorask": "produtora",
            "calendariosk": "calendario",
        },
    ),
    "modelprediction": _table(
        {
            "filmeimdbsk": "long", "filmenome": 128, "anodelancamento": "int", "duracaomin": "int",
            "generonome": 128, "imdbavaliacao": "double", "imdbnumvotos": "double",
            "predicaomodelo": "double", "enderecosk": "long", "calendariosk": "long",
        },
        "filmeimdbsk",
    ),
}

# ---------------------------------------------------------------------------
# The seven external catalogue files, tab separated with header.
# Numeric columns arrive as text, with \N for missing.
# ---------------------------------------------------------------------------
_CATALOGUE_COLUMNS = {
    "title-akas": {
        "titleId": "text", "ordering": "long", "title": "text", "region": "text", "language": "text",
        "types": "text", "attributes": "text", "isOriginalTitle": "long",
    },
    "title-basics": {
        "tconst": "text", "titleType": "text", "primaryTitle": "text", "originalTitle": "text",
        "isAdult": "long", "startYear": "long", "endYear": "long", "runtimeMinutes": "long", "genres": "text",
    },
    "title-crew": {"tconst": "text", "directors": "text", "writers": "text"},
    "title-episode": {
        "tconst": "text", "parentTconst": "text", "seasonNumber": "long", "episodeNumber": "long",
    },
    "title-principals": {
        "tconst": "text", "ordering": "long", "nconst": "text", "category": "text", "job": "text",
        "characters": "text",
    },
    "title-ratings": {"tconst": "text", "averageRating": "double", "numVotes": "long"},
    "name-basics": {
        "nconst": "text", "primaryName": "text", "birthYear": "long", "deathYear": "long",
        "primaryProfession": "text", "knownForTitles": "text",
    },
}
CATALOGUE: dict[str, Table] = {
    name: Table(tuple(Column(c, kind, None, True) for c, kind in columns.items()))
    for name, columns in _CATALOGUE_COLUMNS.items()
}

# The staging table of the recommender, in output order.
PREDICTION_STAGING = [
    "FilmeIMDbSK", "FilmeNome", "AnoDeLancamento", "DuracaoMin", "GeneroNome",
    "IMDbAvaliacao", "IMDbNumVotos", "Estado", "PredicaoModelo",
]
