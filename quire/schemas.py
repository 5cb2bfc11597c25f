"""Declared schemas of the data model. Nothing is inferred; unknown fields are ignored, missing ones are null."""

from __future__ import annotations

_FAILURE = "struct<id:string,sample_id:string,returncode:int,stderr:string,stdout_tail:string,stderr_tail:string,internal_error_marker:boolean,output_exists:boolean>"
_INCIDENT = "struct<batch:int,returncode:int,internal_error_marker:boolean,missing_outputs_before_retry:array<string>,stdout_tail:string,stderr_tail:string>"
_PLACEMENT = "struct<page_id:string,physical_index:int,page_bbox:array<int>,evidence:string,requires_visual_placement_review:boolean>"
_FIGURE = "struct<kind:string,file:string,sha256:string,width:int,height:int,classes:array<string>,placement_evidence:string,label:string,id:string,asset_bbox:array<int>,asset_index:int,requires_visual_placement_review:boolean>"
_BOX = "struct<x1:int,y1:int,x2:int,y2:int>"

SCHEMAS = {
    "source_pages": "id string, physical_index int, source_pdf_sheet int, spread_side string, printed_page int, path string, width int, height int, sha256 string, extraction_method string, extraction_detail string, held_out_benchmark_v1 boolean",
    "text_pages": "schema string, id string, physical_index int, status string, page_type string, source_sha256 string, editorial_batch string, diplomatic_text string, normalized_text string, notes array<string>",
    "ocr_pages": "engine string, page_id string, text string",
    "ocr_runs": f"schema string, engine string, engine_version string, model string, preset string, psm int, tessdata_dir string, device string, precision string, batch_pages int, line_batch_size int, line_workers int, single_retry_enabled boolean, input_manifest string, input_manifest_sha256 string, pages_expected int, pages_written_this_run int, pages_resumed int, pages_available_after_run int, missing_after_run array<string>, failures array<{_FAILURE}>, batch_incidents array<{_INCIDENT}>, ocr_seconds_this_run double, wall_seconds double, system struct<platform:string,python:string>",
    "benchmark_samples": "id string, source_pdf_sheet int, spread_side string, printed_page_hint int, ground_truth_status string, role string",
    "gt_pages": "sample_id string, printed_page int, source_pdf_sheet int, spread_side string, status string, training_use boolean, review_note string, continuation string, gt_text string",
    "ocr_inputs": "sample_id string, preset string, path string, shape_px array<int>, source_page_sha256 string",
    "benchmark_runs": "engine string, model string, psm int, preset string, device string, precision string, sample_id string, seconds double, prediction string, gt_status string, status string",
    "batch_exports": "schema string, source_manifest string, range struct<start:int,end:int,count:int>, engines array<string>, records array<struct<id:string,physical_index:int,source_pdf_sheet:int,spread_side:string,printed_page:int,sha256:string,extraction_method:string,held_out_benchmark_v1:boolean,page_file:string,ocr:map<string,string>>>",
    "batch_references": "schema string, completed_pages int, pages array<struct<id:string,physical_index:int,status:string,path:string>>",
    "probe_assets": "page_id string, width int, height int, page_class string, asset_index int, bbox array<int>, support_pixels int, territory_pixels int, alpha_pixels int, region struct<component_labels:array<int>,seed_labels:array<int>,bbox:array<int>,area:int,extent:int,text_area_fraction:double,max_seed_score:double>, files map<string,string>, sha256 map<string,string>",
    "components": "page_id string, label int, x int, y int, w int, h int, area int, cx double, cy double, line_support double, text_score double, seed_score double",
    "edges": "page_id string, a int, b int, gap double, dx double, dy double, x_overlap_ratio double, y_overlap_ratio double",
    "figures": f"section string, label string, id string, file string, sha256 string, classes array<string>, geometry struct<width:int,height:int,alpha_pixels:int>, source_category string, placement {_PLACEMENT}",
    "placement_overrides": "numbered map<string,struct<page_id:string,physical_index:int,asset_bbox:array<int>,evidence:string>>",
    "frontmatter_policy": "facsimile_pages array<struct<id:string,physical_index:int,page_type:string>>",
    "book_pages": f"id string, physical_index int, page_type string, text string, figures array<{_FIGURE}>, notes array<string>, source_geometry struct<width:int,height:int,printed_page:int>, provenance struct<source_sha256:string,editorial_batch:string>",
    "composition_parts": f"id string, page_id string, asset_index int, clip {_BOX}, asset {_BOX}, output string",
}
