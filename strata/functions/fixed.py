"""Fixed values.

Results depend on these texts being exactly as they are: concept codes, month
names, label spellings, document tags and the chart text.
"""

CONCEPT_ORDINARY = "ORDINARIO"
CONCEPT_EXTRAORDINARY = "EXTRAORDINARIO"

MONTH_NAMES = (
    "Enero",
    "Febrero",
    "Marzo",
    "Abril",
    "Mayo",
    "Junio",
    "Julio",
    "Agosto",
    "Septiembre",
    "Octubre",
    "Noviembre",
    "Diciembre",
)

DATE_FORMAT = "dd/MM/yyyy"

# Text before the floor and before the letter; the two spellings both occur.
LABEL_STYLES = {
    "collection": (" - Piso ", " Depto "),
    "gaps": ("- Piso", " - Depto"),
}

# (row tag, root tag)
XML_COLLECTION_BY_UNIT = (
    "RecaudacionMensualPorUF",
    "Reporte2RecaudacionMensualPorDepartamento",
)
XML_COLLECTION_BY_SOURCE = (
    "RecaudacionTotal",
    "Reporte3RecaudacionTotalSegunProcedencia",
)

CHART_ENDPOINT = "https://quickchart.io/chart?c="
CHART_SIZE = "&width=512&height=512"
CHART_DATASET = "Gastos Ordinarios"
CHART_COLORS = (
    "rgb(54, 162, 235)",
    "rgb(230, 32, 0)",
    "rgb(42, 205, 86)",
    "rgb(255, 159, 64)",
    "rgb(255, 200, 32)",
)
# the chart's text in its order; labels, values, colors and title go between the pieces
CHART_OPEN = '{"type":"doughnut","data":{"labels":'
CHART_DATA = ',"datasets":[{"label":"' + CHART_DATASET + '","data":'
CHART_BACKGROUND = ',"backgroundColor":'
CHART_DATA_END = "}]},"
CHART_OPTIONS = 'options:{title:{display:true,text:"'
CHART_OPTIONS_END = '"'
CHART_OPTIONS_STRICT = '"options":{"title":{"display":true,"text":'
CHART_CLOSE = "}}}"
CHART_TITLE = "Distribucion de Gastos Ordinarios por Categoria - Consorcio: "
CHART_TITLE_MONTH = " - Mes: "
CHART_TITLE_YEAR = " Año: "
