"""Declared contract of the fourteen registry tables.

A :class:`TableSpec` says which file feeds a table, what its columns are, how
long a text may be, what may be NULL and which keys must hold.  Readers take
their schema from here, the quarantine takes its rules from here and the
quality checks walk the foreign keys declared here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


# Fixed value: this table is cut from the lines of another one, so its rows are
# left out of totals.
DERIVED_TABLE = "estabelecimento_cnae_sec"
SOURCE_OF_DERIVED = "estabelecimento"


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    max_len: int | None = None
    required: bool = False
    exact_len: bool = False
    derived: bool = False  # computed by the load, not present in the file


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    stem: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = field(default=())
    unique_keys: tuple[tuple[str, ...], ...] = ()

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        """Typed schema of the loaded table."""
        return T.StructType([T.StructField(c.name, c.dtype, True) for c in self.columns])

    @property
    def file_schema(self) -> T.StructType:
        """Positional, all-text layout of the headerless source file."""
        return T.StructType(
            [T.StructField(c.name, T.StringType(), True) for c in self.columns if not c.derived]
        )

    @property
    def date_columns(self) -> list[str]:
        return [c.name for c in self.columns if isinstance(c.dtype, T.DateType)]

    @property
    def decimal_columns(self) -> list[str]:
        return [c.name for c in self.columns if isinstance(c.dtype, T.DecimalType)]

    def __getitem__(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)


def text(name: str, max_len: int | None = None, **flags) -> Column:
    return Column(name, T.StringType(), max_len, **flags)


def date(name: str, **flags) -> Column:
    return Column(name, T.DateType(), **flags)


def integer(name: str, **flags) -> Column:
    return Column(name, T.IntegerType(), **flags)


def small(name: str, **flags) -> Column:
    return Column(name, T.ShortType(), **flags)


def decimal(name: str, precision: int, scale: int, **flags) -> Column:
    return Column(name, T.DecimalType(precision, scale), **flags)


def _code_table(name, stem, code, code_len, label, label_len) -> TableSpec:
    return TableSpec(
        name,
        stem,
        (text(code, code_len, required=True), text(label, label_len, required=True)),
        primary_key=(code,),
    )


# Names, lengths and keys are the registry's contract.
_SPECS = (
    _code_table("cnae", "Cnaes", "cod_cnae", 7, "nome_cnae", 200),
    _code_table("motivo", "Motivos", "cod_motivo", 2, "nome_motivo", 100),
    _code_table("municipio_rfb", "Municipios", "cod_municipio", 7, "nome_municipio", 120),
    _code_table("natureza_juridica", "Naturezas", "cod_natureza", 4, "nome_natureza", 200),
    _code_table("pais", "Paises", "cod_pais", 3, "nome_pais", 60),
    _code_table(
        "qualificacao_socio", "Qualificacoes", "cod_qualificacao", 2, "nome_qualificacao", 200
    ),
    TableSpec(
        "ibge_regiao",
        "RegioesIbge",
        (
            integer("cod_regiao_ibge", required=True),
            text("sigla_regiao", 2),
            text("nome_regiao", 50, required=True),
        ),
        primary_key=("cod_regiao_ibge",),
        unique_keys=(("sigla_regiao",),),
    ),
    TableSpec(
        "ibge_estado",
        "EstadosIbge",
        (
            integer("cod_estado_ibge", required=True),
            text("sigla_uf", 2, required=True),
            text("nome_estado", 100, required=True),
            decimal("latitude", 9, 6),
            decimal("longitude", 9, 6),
            integer("cod_regiao_ibge", required=True),
        ),
        primary_key=("cod_estado_ibge",),
        unique_keys=(("sigla_uf",),),
        foreign_keys=(ForeignKey("cod_regiao_ibge", "ibge_regiao", "cod_regiao_ibge"),),
    ),
    TableSpec(
        "ibge_cidade",
        "CidadesIbge",
        (
            integer("cod_cidade_ibge", required=True),
            text("nome_cidade", 120, required=True),
            decimal("latitude", 9, 6),
            decimal("longitude", 9, 6),
            Column("capital", T.BooleanType()),
            integer("cod_estado_ibge", required=True),
            text("cod_municipio", 7),
            text("ddd", 3),
            text("fuso_horario", 50),
        ),
        primary_key=("cod_cidade_ibge",),
        unique_keys=(("cod_municipio",),),
        foreign_keys=(ForeignKey("cod_estado_ibge", "ibge_estado", "cod_estado_ibge"),),
    ),
    TableSpec(
        "empresa",
        "Empresas",
        (
            text("cnpj_basico", 8, required=True),
            text("razao_social", 200),
            text("cod_natureza_juridica", 4, required=True),
            text("cod_qualificacao_responsavel", 2, required=True),
            decimal("capital_social", 16, 2, required=True),
            text("cod_porte", 2),
            text("ente_federativo_responsavel", 100),
        ),
        primary_key=("cnpj_basico",),
        foreign_keys=(
            ForeignKey("cod_natureza_juridica", "natureza_juridica", "cod_natureza"),
            ForeignKey("cod_qualificacao_responsavel", "qualificacao_socio", "cod_qualificacao"),
        ),
    ),
    TableSpec(
        "estabelecimento",
        "Estabelecimentos",
        (
            text("cnpj_basico", 8, required=True),
            text("cnpj_ordem", 4, required=True),
            text("cnpj_dv", 2, required=True),
            text("cnpj_completo", 14, required=True, exact_len=True, derived=True),
            text("matriz_filial", 1, required=True),
            text("nome_fantasia", 60),
            text("cod_situacao_cadastral", 2, required=True),
            date("data_situacao_cadastral"),
            text("cod_motivo_situacao_cadastral", 2, required=True),
            text("nome_cidade_exterior", 60),
            text("cod_pais", 3),
            date("data_inicio_atividade", required=True),
            text("cod_cnae_principal", 7, required=True),
            text("cod_cnae_secundario"),
            text("tipo_logradouro", 20),
            text("logradouro", 60),
            text("numero", 6),
            text("complemento", 200),
            text("bairro", 60),
            text("cep", 8),
            text("uf", 2, required=True),
            text("cod_municipio", 7),
            text("ddd_telefone_1", 4),
            text("telefone_1", 10),
            text("ddd_telefone_2", 4),
            text("telefone_2", 10),
            text("ddd_fax", 4),
            text("fax", 10),
            text("email"),
            text("situacao_especial", 100),
            date("data_situacao_especial"),
            integer("cod_regiao_ibge", derived=True),
            integer("cod_estado_ibge", derived=True),
            integer("cod_cidade_ibge", derived=True),
        ),
        primary_key=("cnpj_completo",),
        foreign_keys=(
            ForeignKey("cnpj_basico", "empresa", "cnpj_basico"),
            ForeignKey("cod_cnae_principal", "cnae", "cod_cnae"),
            ForeignKey("cod_pais", "pais", "cod_pais"),
            ForeignKey("cod_motivo_situacao_cadastral", "motivo", "cod_motivo"),
            ForeignKey("cod_regiao_ibge", "ibge_regiao", "cod_regiao_ibge"),
            ForeignKey("cod_estado_ibge", "ibge_estado", "cod_estado_ibge"),
            ForeignKey("cod_cidade_ibge", "ibge_cidade", "cod_cidade_ibge"),
        ),
    ),
    TableSpec(
        "simples",
        "Simples",
        (
            text("cnpj_basico", 8, required=True),
            text("opcao_simples", 1),
            date("data_opcao_simples"),
            date("data_exclusao_simples"),
            text("opcao_mei", 1),
            date("data_opcao_mei"),
            date("data_exclusao_mei"),
        ),
        primary_key=("cnpj_basico",),
        foreign_keys=(ForeignKey("cnpj_basico", "empresa", "cnpj_basico"),),
    ),
    TableSpec(
        "socio",
        "Socios",
        (
            text("cnpj_basico", 8, required=True),
            text("identificador_socio", 1, required=True),
            text("nome_socio", 200),
            text("cnpj_cpf_socio", 14),
            text("cod_qualificacao_socio", 2, required=True),
            date("data_entrada_sociedade", required=True),
            text("cod_pais", 3),
            text("cpf_representante_legal", 11),
            text("nome_representante_legal", 100),
            text("cod_qualificacao_representante_legal", 2),
            text("cod_faixa_etaria", 1, required=True),
        ),
        foreign_keys=(
            ForeignKey("cnpj_basico", "empresa", "cnpj_basico"),
            ForeignKey("cod_pais", "pais", "cod_pais"),
            ForeignKey("cod_qualificacao_socio", "qualificacao_socio", "cod_qualificacao"),
            ForeignKey(
                "cod_qualificacao_representante_legal", "qualificacao_socio", "cod_qualificacao"
            ),
        ),
    ),
    TableSpec(
        "estabelecimento_cnae_sec",
        "Estabelecimentos",
        (
            text("cnpj_completo", 14, required=True, exact_len=True, derived=True),
            text("cod_cnae", 7, required=True, derived=True),
            small("cod_regiao_ibge", derived=True),
            small("cod_estado_ibge", derived=True),
            integer("cod_cidade_ibge", derived=True),
            date("data_inicio_atividade"),
        ),
        foreign_keys=(
            ForeignKey("cnpj_completo", "estabelecimento", "cnpj_completo"),
            ForeignKey("cod_cnae", "cnae", "cod_cnae"),
        ),
    ),
)

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}


def spec(name: str) -> TableSpec:
    return TABLES[name]


def file_fields(name: str) -> int:
    """Cells in a line of the file that feeds a table."""
    return len(spec(SOURCE_OF_DERIVED if name == DERIVED_TABLE else name).file_schema)
