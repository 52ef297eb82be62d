"""NumPy kernels: numerical gradients, layer semantics, recurrent reference."""

import numpy as np
import pytest

from layerwise.operators import kernels as K
from layerwise.operators.model import (Net, Vertex, activation_layer, conv2d, dense, output, pool2d,
                                       zeropad_layer)
from layerwise.operators.training import _onehot


def _num_check(net, feeds, labels, n_checks=25, seed=0):
    _, grads, _ = net.loss_and_grads(feeds, labels, train=False)
    rng = np.random.default_rng(seed)
    for key, arr in net.params.items():
        flat = arr.ravel()
        for idx in rng.choice(flat.size, size=min(n_checks, flat.size), replace=False):
            old = flat[idx]
            flat[idx] = old + 1e-6
            lp, _, _ = net.loss_and_grads(feeds, labels, train=False)
            flat[idx] = old - 1e-6
            lm, _, _ = net.loss_and_grads(feeds, labels, train=False)
            flat[idx] = old
            num = (lp - lm) / 2e-6
            assert abs(num - grads[key].ravel()[idx]) < 1e-5 * max(1.0, abs(num)), (key, idx)


def test_gradient_conv_pool_dense():
    net = Net.sequential((1, 8, 8), [conv2d(3, (3, 3)), pool2d((2, 2), (2, 2)), dense(6, "tanh"),
                                     output(4, "softmax", "nll")]).init(seed=1)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(5, 64))
    y = _onehot(rng.integers(0, 4, 5), 4)
    _num_check(net, {"input": x}, {net.outputs[0]: y})


def test_gradient_same_mode_strided_conv_and_padding():
    net = Net.sequential((2, 5, 5), [zeropad_layer(1), conv2d(2, (3, 3), (2, 2), mode="same"),
                                     activation_layer("sigmoid"), output(3, "softmax", "nll")]).init(seed=2)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4, 50))
    y = _onehot(rng.integers(0, 3, 4), 3)
    _num_check(net, {"input": x}, {net.outputs[0]: y})


def test_gradient_graph_two_inputs_two_losses():
    vs = [Vertex("a", "layer", ["in1"], dense(4, "leakyrelu")), Vertex("b", "layer", ["in2"], dense(4, "relu")),
          Vertex("m", "merge", ["a", "b"]), Vertex("o1", "layer", ["m"], output(3, "softmax", "nll")),
          Vertex("o2", "layer", ["m"], output(2, "identity", "mse"))]
    net = Net({"in1": (3,), "in2": (3,)}, vs, ["o1", "o2"]).init(seed=3)
    rng = np.random.default_rng(2)
    feeds = {"in1": rng.normal(size=(6, 3)), "in2": rng.normal(size=(6, 3))}
    labels = {"o1": _onehot(rng.integers(0, 3, 6), 3), "o2": rng.normal(size=(6, 2))}
    _num_check(net, feeds, labels)


def test_conv_matches_direct_loops():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2, 3, 6, 5))
    W = rng.normal(size=(4, 3, 3, 2))
    b = rng.normal(size=4)
    out = K.conv2d(x, W, b, (2, 1), (1, 0), "truncate")
    xp = np.pad(x, ((0, 0), (0, 0), (1, 1), (0, 0)))
    oh, ow = (6 + 2 - 3) // 2 + 1, (5 - 2) // 1 + 1
    ref = np.zeros((2, 4, oh, ow))
    for n in range(2):
        for o in range(4):
            for yy in range(oh):
                for xx in range(ow):
                    ref[n, o, yy, xx] = (xp[n, :, yy * 2:yy * 2 + 3, xx:xx + 2] * W[o]).sum() + b[o]
    assert np.allclose(out, ref)


def test_same_padding_output_size():
    for size in range(1, 12):
        for k in (1, 2, 3, 5):
            for s in (1, 2, 3):
                pads, oh, _ = K.conv_geometry(size, size, k, k, s, s, 0, 0, "same")
                assert oh == -(-size // s)


def test_lrn_constant_channels():
    x = np.ones((1, 4, 2, 2))
    out = K.lrn(x)
    # channel 0 sees channels 0..2 (3 squares), channel 1 sees 0..3 (4)
    assert np.allclose(out[0, 0], 1 / (2 + 1e-4 * 3) ** 0.75)
    assert np.allclose(out[0, 1], 1 / (2 + 1e-4 * 4) ** 0.75)


def test_softmax_rows_sum_to_one():
    z = np.random.default_rng(4).normal(size=(20, 7)) * 50
    assert np.allclose(K.activate(z, "softmax").sum(axis=1), 1.0)


def test_lstm_reference_matches_batched_step():
    from layerwise.operators.sequence import lstm_params, lstm_reference
    p = lstm_params(5, 5, 5, seed=0)
    xs = np.random.default_rng(5).normal(size=(7, 5))
    out = lstm_reference(xs, p, 5)
    assert out.shape == (7, 5)
    assert np.allclose(out.sum(axis=1), 1.0)
    # first step equals a single step from zero state
    h, c = K.lstm_step(xs[:1], np.zeros((1, 5)), np.zeros((1, 5)), p["Wx"], p["Wh"], p["b"], p["peep"])
    z = np.concatenate([xs[:1], h], axis=1) @ p["Wo"] + p["bo"]
    assert np.allclose(out[0], K.activate(z, "softmax")[0])


@pytest.mark.parametrize("kind", ["identity", "relu", "leakyrelu", "sigmoid", "tanh"])
def test_activation_gradients(kind):
    z = np.linspace(-2, 2, 11).reshape(1, -1) + 0.05
    a = K.activate(z, kind)
    g = K.activate_grad(z, a, np.ones_like(z), kind)
    num = (K.activate(z + 1e-6, kind) - K.activate(z - 1e-6, kind)) / 2e-6
    assert np.allclose(g, num, atol=1e-6)
