"""Row types of notices, documents and the store."""

from __future__ import annotations

LINK = "struct<text:string,href:string>"
NOTICE = (
    "page_number int, row_number int, sequence_number string, jurisdiction string, bankruptcy_trustee string, "
    f"notice_title string, view_count string, additional_fields map<string,string>, links array<{LINK}>"
)
#: One sparse type for the three kinds of attachment links; ``kind_order``, ``extension_order`` and ``position`` give their order.
ATTACHMENT = "struct<type:string,file_id:string,display_name:string,link_text:string,href:string,file_extension:string,filename:string,onclick:string>"
BBOX = "struct<x0:double,y0:double,x1:double,y1:double>"

PDF_DOCUMENTS = (
    "id bigint, notice_id string, file_path string, file_name string, file_size bigint, page_count int, "
    "processed_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"
)
_BOX = "bbox_x0 double, bbox_y0 double, bbox_x1 double, bbox_y1 double"
PDF_TEXT = f"id bigint, document_id bigint, page_number int, text_content string, {_BOX}, font_size double, font_name string, created_at timestamp_ntz"
PDF_TABLES = (
    "id bigint, document_id bigint, page_number int, table_index int, "
    f"table_data struct<rows:array<array<string>>,row_count:int,col_count:int>, row_count int, col_count int, {_BOX}, created_at timestamp_ntz"
)
PDF_IMAGES = (
    "id bigint, document_id bigint, page_number int, image_index int, image_path string, width int, height int, "
    f"format string, file_size bigint, {_BOX}, created_at timestamp_ntz"
)
STORE = {"pdf_documents": PDF_DOCUMENTS, "pdf_text_content": PDF_TEXT, "pdf_tables": PDF_TABLES, "pdf_images": PDF_IMAGES}

#: Equality of the store's strings: case, accents and trailing spaces do not count. Close to, not the same as, the server collation it stands for.
COLLATION = "UNICODE_CI_AI_RTRIM"
