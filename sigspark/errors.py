class ValidationError(ValueError):
    """Raised when an input frame does not meet an operator's contract."""


def require_columns(df, columns, what="frame"):
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValidationError(f"{what} is missing required columns: {missing}")
