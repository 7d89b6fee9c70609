from wardline.functions.scalar import (  # noqa: F401
    age_at, category, fmt_fixed, patient_key, py_float, py_strip, is_py_float,
)
