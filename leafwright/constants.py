"""Fixed values that results depend on: class names and sets, thresholds, prompts, tags."""

#: Layout classes by label.
CLASSES = (
    "abstract",
    "algorithm",
    "aside_text",
    "chart",
    "content",
    "display_formula",
    "doc_title",
    "figure_title",
    "footer",
    "footer_image",
    "footnote",
    "formula_number",
    "header",
    "header_image",
    "image",
    "inline_formula",
    "number",
    "paragraph_title",
    "reference",
    "reference_content",
    "seal",
    "table",
    "text",
    "vertical_text",
    "vision_footnote",
)
MERGE_LARGE = ("chart", "display_formula", "doc_title", "inline_formula", "paragraph_title")
PICTORIAL = ("image", "table", "seal", "chart")
VISUAL_ONLY = ("chart", "image", "header_image", "footer_image", "seal")
TEXT_CATEGORIES = (
    "text_block",
    "title",
    "code_txt",
    "code_txt_caption",
    "reference",
    "equation_caption",
    "figure_caption",
    "figure_footnote",
    "table_caption",
    "table_footnote",
    "code_algorithm",
    "code_algorithm_caption",
    "header",
    "footer",
    "page_footnote",
    "page_number",
)

RAW_SCORE, REFERENCE_SCORE = 0.5, 0.3
NEST_SHARE, MERGE_SHARE = 0.8, 0.9
IOU_SAME, IOU_OTHER = 0.6, 0.98
PAGE_SHARE_WIDE, PAGE_SHARE_TALL = 0.82, 0.93
OVERLAP_FORMULA, OVERLAP_OTHER, SLIVER = 0.5, 0.7, 6.0
FLOOR_TABLE, FLOOR_TEXT = 5000, 50
LAYOUT_ADD_BACK, FIRST_VALID_INDEX = 0.88, 211
CROP_BUCKETS = ((1, 5), (6, 10), (11, 15), (16, 25), (26, 40), (41, 200))

PROMPT_DEFAULT = "OCR:"
PROMPTS = {
    "table": "Table Recognition:",
    "display_formula": "Formula Recognition:",
    "inline_formula": "Formula Recognition:",
    "chart": "Chart Recognition:",
    "seal": "Seal Recognition:",
}
OTSL_TAGS = ("<fcel>", "<ecel>", "<lcel>", "<ucel>", "<xcel>")

#: Unicode White_Space, which text is trimmed by.
WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"
