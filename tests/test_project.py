import numpy as np

from themewell.operators import project


def test_two_axes_equal_the_eigenvectors(vectors_of):
    x = np.random.default_rng(0).normal(size=(60, 16)) * np.linspace(3, 0.5, 16)
    x = x.astype(np.float32).astype(float)
    rows = sorted(project.project_2d(vectors_of(x)).collect())
    assert len(rows) == 60 and {r.method for r in rows} == {"pca"}
    _, axes = np.linalg.eigh(np.cov(x.T))
    for name, axis in (("x", axes[:, -1]), ("y", axes[:, -2])):
        axis = axis * np.sign(axis[np.abs(axis).argmax()])
        assert np.allclose([getattr(r, name) for r in rows], x @ axis, atol=1e-6)
