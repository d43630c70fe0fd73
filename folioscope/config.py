"""All thresholds of section location, as data."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EngineConfig:
    # Fixed values.
    min_years: int = 3
    window_buffer: float = 0.30
    window_min_pages: int = 30
    window_min_buffer: int = 5
    sample_pages: int = 30
    sample_radius: int = 10
    walk_pages: int = 5
    toc_pages: int = 10
    toc_offsets: int = 5
    matched_chars: int = 60
    toc_tail_chars: int = 80
    toc_lines: int = 3
    toc_like_chars: int = 100
    toc_like_dotted: int = 3
    toc_like_dotless: int = 5
    bottom: float = 0.4
    script_share: float = 0.30
    head_chars: int = 300
    walk_head_chars: int = 600
    walk_min_chars: int = 50
    text_layer_chars: int = 200
    error_chars: int = 200
    # Page classifier.
    attempts: int = 3
    requests_a_minute: int = 200
    cooldown_s: float = 65.0
    dpi: int = 200
    image_quality: int = 80
    image_detail: str = "low"
    model: str = "gpt-4o-mini"
    base_url: str = "https://api.openai.com/v1"
    reply_tokens: int = 50
    # Output folders and files. Fixed values.
    sections_dir: str = "comments_mentioned/cag_pages"
    missing_dir: str = "no_comments_content"
    archive_dir: str = "archives"
    ledger_dir: str = "_ledger"
    report_dir: str = "missing_years_report"
    empty_dir: str = "companies_without_files"
    #: Tasks that ask the classifier at once.
    ask_tasks: int = 8
    use_ledger_consensus: bool = False
    """Whether sections that earlier runs confirmed count for the consensus; otherwise only this run's do."""
