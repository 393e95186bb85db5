from tierline.functions.columns import (  # noqa: F401
    TRANSFORMS,
    apply_casts,
    apply_named,
    fix_protocol,
    flag_present,
    flag_zero,
    register_transform,
    string_columns,
    trim_strings,
    with_protocol,
)
