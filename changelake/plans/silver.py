"""The silver table: two bronze sources conformed to 29 columns and united."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from changelake.operators.conform import Target, conform, drop_soft_deleted, union_conformed
from changelake.sources.readers import read_sources

# The target columns, and per source the column and cleaner of each.
TARGETS = (
    ("STT", "string"),
    ("Mã KH", "string"),
    ("Mã HĐ", "string"),
    ("Mã nhân viên", "string"),
    ("NV quản lý", "string"),
    ("Mã lái xe", "string"),
    ("ID cuốc xe", "string"),
    ("Số thẻ", "string"),
    ("Tên trên thẻ", "string"),
    ("Sản phẩm", "string"),
    ("Số tiền", "bigint"),
    ("Số giao dịch", "string"),
    ("Mã giao dịch", "string"),
    ("Mã tài", "string"),
    ("Ngày giao dịch", "date"),
    ("Thời điểm giao dịch", "string"),
    ("Ngày đi thực tế", "string"),
    ("Ngày hiệu lực", "string"),
    ("Biển số xe", "string"),
    ("Điểm đón", "string"),
    ("Điểm trả", "string"),
    ("Đơn vị phát sinh", "string"),
    ("Mã ĐV phát sinh", "string"),
    ("Tên ĐV phát sinh", "string"),
    ("Mã ĐV quản lý KH", "string"),
    ("Tên ĐV quản lý KH", "string"),
    ("Trạng thái giao dịch", "string"),
    ("Loại giao dịch", "string"),
    ("Ghi chú", "string"),
)
SOURCE_A = {
    "STT": ("stt", "raw"),
    "Mã nhân viên": ("ma_nv", "code"),
    "Số thẻ": ("so_the", "raw"),
    "Tên trên thẻ": ("ten_in_tren_the", "ws"),
    "Sản phẩm": ("san_pham", "ws"),
    "Số tiền": ("so_tien", "number"),
    "Số giao dịch": ("so_giao_dich", "code"),
    "Ngày đi thực tế": ("ngay_di_thuc_te", "date"),
    "Ngày hiệu lực": ("ngay_hieu_luc", "date"),
    "Biển số xe": ("bs_xe", "code"),
    "Điểm đón": ("diem_don_ghi_chu", "ws"),
    "Điểm trả": ("diem_tra", "ws"),
    "Đơn vị phát sinh": ("don_vi_phat_sinh", "ws"),
}
SOURCE_B = {
    "STT": ("stt", "int"),
    "Mã KH": ("ma_kh", "code"),
    "Mã HĐ": ("ma_hd", "code"),
    "NV quản lý": ("nv_quan_ly", "code"),
    "Mã lái xe": ("ma_lai_xe", "code"),
    "ID cuốc xe": ("id_cuoc_xe", "code"),
    "Số thẻ": ("so_the", "raw"),
    "Tên trên thẻ": ("ten_in_tren_the", "ws"),
    "Sản phẩm": ("san_pham", "ws"),
    "Số tiền": ("so_tien", "number"),
    "Mã giao dịch": ("ma_gd", "code"),
    "Mã tài": ("so_tai", "code"),
    "Thời điểm giao dịch": ("thoi_diem_giao_dich", "date"),
    "Mã ĐV phát sinh": ("ma_dv_phat_sinh_gd", "code"),
    "Tên ĐV phát sinh": ("ten_dv_phat_sinh_gd", "ws"),
    "Trạng thái giao dịch": ("trang_thai", "ws"),
    "Loại giao dịch": ("loai_gd", "ws"),
}


def spec(mapping: Mapping[str, tuple[str, str]]) -> list[Target]:
    return [Target(name, kind, *mapping.get(name, ())) for name, kind in TARGETS]


SPEC_A, SPEC_B = spec(SOURCE_A), spec(SOURCE_B)


def unify(source_a: DataFrame, source_b: DataFrame) -> DataFrame:
    """Live rows of both sources in the silver schema; a plan without shuffles."""
    return union_conformed(
        conform(drop_soft_deleted(source_a), SPEC_A),
        conform(drop_soft_deleted(source_b), SPEC_B),
    )


def write_silver(spark: SparkSession, path_a: str, path_b: str, target: str) -> int:
    """Build the silver dataset and return its row count, taken during the write.

    Nothing is written unless both sources can be read; the error names each
    that cannot.
    """
    paths = {"a": path_a, "b": path_b}
    found, failed = read_sources(spark, paths)
    if failed:
        raise ValueError(f"cannot read { {paths[n]: why for n, why in failed.items()} }")
    rows = Observation("silver")
    silver = unify(found["a"], found["b"]).observe(rows, F.count(F.lit(1)).alias("rows"))
    silver.write.mode("overwrite").parquet(target)
    return rows.get["rows"]
