"""Settings of the engine: a frozen record, from defaults, a mapping or the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields


# What settings of a choice may be.
CHOICES = {
    "binarization_mode": ("otsu", "adaptive"),
    "region_detection_strategy": ("auto", "template", "adaptive", "text_based"),
    "table_detection_strategy": ("morphology", "template", "auto"),
    "log_level": ("CRITICAL", "ERROR", "WARNING", "INFO", "DEBUG"),
}


@dataclass(frozen=True)
class Settings:
    """Thresholds and sizes; pixels where nothing else is said.

    Settings that only steer an engine's processes (pools, workers, memory limits) have no counterpart:
    Spark's executors take their place, and such names in the environment are ignored.
    """

    # Names and defaults, as existing environments and .env files have them.
    input_dir: str = "images"
    output_dir: str = "results"
    log_dir: str = "logs"
    log_level: str = "INFO"
    log_max_size_mb: int = 10
    ocr_language: str = "ru"
    ocr_confidence_threshold: float = 0.5
    ocr_max_image_dimension: int = 3000
    enable_adaptive_scaling: bool = True
    adaptive_scaling_min_mp: float = 4.0
    adaptive_scaling_target_mp: float = 5.0
    adaptive_scaling_max_width: int = 3000
    adaptive_scaling_max_height: int = 2000
    enable_deskew: bool = True
    enable_perspective_correction: bool = True
    perspective_min_area_ratio: float = 0.2
    perspective_corner_epsilon: float = 0.02
    perspective_target_width_limit: int = 3000
    perspective_target_height_limit: int = 2000
    perspective_min_corner_distance: int = 50
    enable_denoising: bool = True
    processed_suffix: str = "-cor"
    template_name: str = "otk_v1"
    binarization_mode: str = "otsu"
    gaussian_blur_kernel: int = 3
    enable_illumination_correction: bool = True
    illumination_kernel: int = 31
    adaptive_block_size: int = 31
    adaptive_c: int = 7
    use_morphological_enhancement: bool = True
    gamma_correction: float = 0.7
    enable_region_detection: bool = True
    region_detection_strategy: str = "auto"
    region_min_confidence: float = 0.7
    region_max_width: int = 3000
    region_max_height: int = 2000
    region_horizontal_line_min_width_ratio: float = 0.7
    region_template_file: str = "config/templates/regions.json"
    region_min_header_ratio: float = 0.20
    region_max_header_ratio: float = 0.25
    region_min_defects_ratio: float = 0.25
    region_max_defects_ratio: float = 0.60
    region_adaptive_template_tolerance: float = 0.10
    enable_table_detection: bool = True
    table_detection_strategy: str = "auto"
    table_h_kernel_ratio: float = 0.5
    table_v_kernel_ratio: float = 0.5
    table_line_min_length_ratio: float = 0.7
    table_line_merge_threshold: int = 10
    table_cell_margin: int = 2
    table_cell_preprocess: bool = True
    table_cell_min_width: int = 20
    table_cell_min_height: int = 15
    table_enable_empty_cell_detection: bool = True
    table_empty_edge_density_threshold: float = 0.01
    table_empty_white_pixel_threshold: float = 0.95
    table_empty_variance_threshold: float = 100.0
    table_empty_component_threshold: int = 2
    table_template_file: str = "config/templates/table_templates.json"
    header_field_enable_specialized_extraction: bool = True
    header_blank_area_x_min: float = 70.0
    header_blank_area_y_max: float = 8.0
    header_blank_min_confidence: float = 0.4
    header_enable_slash_correction: bool = True
    header_enable_digit_correction: bool = True

    def __post_init__(self):
        for name in ("gaussian_blur_kernel", "illumination_kernel", "adaptive_block_size"):
            if getattr(self, name) <= 0 or getattr(self, name) % 2 == 0:
                raise ValueError(f"{name} must be odd and positive")
        if self.illumination_kernel < 15:
            raise ValueError("illumination_kernel must be 15 at least")
        for name, known in CHOICES.items():
            if getattr(self, name) not in known:
                raise ValueError(f"{name} must be one of {', '.join(known)}")
        for name in ("perspective_target_width_limit", "perspective_target_height_limit", "perspective_min_corner_distance"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        for f in fields(self):
            if ("ratio" in f.name or f.name == "perspective_corner_epsilon") and not 0 < getattr(self, f.name) <= 1:
                raise ValueError(f"{f.name} must lie in (0, 1]")


def load(values: Mapping[str, str] | None = None, env_file: str | None = None) -> Settings:
    """From the environment, or from values; a file of NAME=value lines goes below both."""
    read: dict[str, str] = {}
    if env_file and os.path.exists(env_file):
        with open(env_file, encoding="utf-8") as lines:
            for line in lines:
                name, mark, value = line.strip().partition("=")
                if mark and not name.startswith("#"):
                    read[name.strip().lower()] = value.strip().strip("\"'")
    read |= {k.lower(): v for k, v in (os.environ if values is None else values).items()}
    made = {}
    for f in fields(Settings):
        if f.name in read:
            text, kind = read[f.name], type(f.default)
            made[f.name] = text.strip().lower() in ("1", "true", "yes", "on") if kind is bool else kind(text)
    return Settings(**made)
