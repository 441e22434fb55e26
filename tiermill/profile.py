"""Settings of one data domain. Everything the jobs need to know about a source lives here."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Profile:
    """``kinds`` names the two measures; ``amount_patterns`` is keyed by kind."""

    kinds: tuple[str, str]
    manifest: tuple[tuple[str, str, int], ...]
    amount_patterns: dict[str, tuple[str, ...]]
    region_patterns: tuple[str, ...]
    entity_patterns: tuple[str, ...]
    category_patterns: tuple[str, ...]
    region_contains: str
    skip_sheets: tuple[str, ...]
    header_any: tuple[str, ...]
    header_all: tuple[str, ...]
    default_header_row: int
    members: tuple[str, ...]
    member_labels: tuple[str, str] = ("member", "other")
    trend_labels: tuple[str, str, str, str] = ("base", "up", "down", "same")
    csv_names: dict[str, str] = field(default_factory=dict)
    export_headers: dict[str, str] = field(default_factory=dict)
    view_names: dict[str, str] = field(default_factory=dict)
    view_columns: dict[str, str] = field(default_factory=dict)
    periods: tuple[int, ...] | None = None
    categories: tuple[tuple[str, str, str], ...] = ()


# File ids, words, list entries and column names of the published
# higher-education workbooks. Order in the manifest decides which file wins.
HIGHER_EDUCATION = Profile(
    kinds=("estudiantes", "docentes"),
    manifest=(
        ("articles-425156_recurso", "docentes", 2024),
        ("articles-425151_recurso", "estudiantes", 2024),
        ("articles-421539_recurso", "estudiantes", 2023),
        ("articles-421822_recurso", "docentes", 2023),
        ("articles-416244_recurso", "estudiantes", 2022),
        ("articles-416249_recurso", "docentes", 2022),
    ),
    amount_patterns={
        "estudiantes": ("matriculados", "estudiantes", "inscritos", "admitidos"),
        "docentes": ("no. de docentes", "numero de docentes", "docentes", "no docentes"),
    },
    region_patterns=("departamento domicilio ies",),
    entity_patterns=(
        "institución educación superior ies",
        "institución educación superior",
    ),
    category_patterns=("sector ies",),
    region_contains="bogota",
    skip_sheets=("índice", "indice", "sumario", "contenido", "tabla", "resumen"),
    header_any=("institución", "código"),
    header_all=("departamento",),
    default_header_row=7,
    members=(
        "universidad atlántico",
        "universidad de cartagena",
        "universidad popular del cesar",
        "universidad de córdoba",
        "universidad de la guajira",
        "universidad de magdalena",
        "universidad de sucre",
        "universidad distrital francisco josé de caldas",
        "universidad distrital-francisco jose de caldas",
        "universidad colegio mayor de cundinamarca",
        "universidad-colegio mayor de cundinamarca",
        "universidad militar nueva granada",
        "universidad militar-nueva granada",
        "universidad pedagógica nacional",
        "universidad pedagogica nacional",
        "universidad nacional de colombia",
        "universidad pedagógica y tecnológica de colombia",
        "universidad de cundinamarca",
        "universidad nacional abierta y a distancia",
        "unad",
        "universidad del tolima",
        "universidad surcolombiana",
        "universidad de antioquia",
        "universidad tecnológica de pereira",
        "universidad del quindío",
        "universidad de caldas",
        "universidad del valle",
        "universidad del cauca",
        "universidad de nariño",
        "universidad del pacífico",
        "universidad de la amazonia",
        "universidad autónoma intercultural indígena",
        "universidad tecnológica del chocó",
        "universidad de los llanos",
        "universidad de pamploma",
        "universidad industrial de santander",
        "universidad francisco de paula santander",
    ),
    member_labels=("SUE", "No SUE"),
    trend_labels=("Año base", "Aumentó", "Disminuyó", "Sin cambio"),
    csv_names={
        "entity": "nombre_ies",
        "period": "año",
        "measure_a": "total_estudiantes",
        "measure_b": "total_docentes",
        "ratio": "estudiantes_por_docente",
        "category": "sector_ies",
        "label": "clasificacion_sue",
    },
    export_headers={
        "entity": "Institución",
        "category": "Sector",
        "label": "Clasificación",
        "period": "Año",
        "measure_a": "Total Estudiantes",
        "measure_b": "Total Docentes",
        "ratio": "Estudiantes por Docente",
    },
    view_names={
        "ratio_report": "v_relacion_estudiante_docente",
        "member_averages": "v_promedio_por_sue",
        "top_by_ratio": "v_top_ies_by_ratio",
        "evolution": "v_evolucion_ies",
    },
    view_columns={
        "entity": "nombre_ies",
        "category": "sector_ies",
        "is_member": "es_sue",
        "label": "clasificacion_sue",
        "period": "año",
        "measure_a": "total_estudiantes",
        "measure_b": "total_docentes",
        "ratio": "estudiantes_por_docente",
        "rank_desc": "rank_ratio_desc",
        "rank_asc": "rank_ratio_asc",
        "position": "posicion",
        "prev_ratio": "ratio_ano_anterior",
        "n_entities": "cantidad_ies",
        "avg_a": "promedio_estudiantes",
        "avg_b": "promedio_docentes",
        "avg_ratio": "promedio_ratio",
        "group_label": "tipo",
    },
    categories=(
        ("oficial", "Oficial", "Institución pública/estatal"),
        ("privado", "Privado", "Institución privada"),
        ("desconocido", "Desconocido", "Sector sin clasificar"),
    ),
)
